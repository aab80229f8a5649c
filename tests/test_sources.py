"""Sources and merges: binary files, legacy JSON stores, latest-per-key."""

import json
import os

import pytest
from pyspark.sql import functions as F

from webledger.operators import payload
from webledger.operators import search as S
from webledger.operators.search import parse_documents
from webledger.sources import tables


def test_read_files_and_parse(spark, tmp):
    os.makedirs(f"{tmp}/in/sub")
    open(f"{tmp}/in/a.html", "w").write("<h1>Hi</h1><p>there</p>")
    open(f"{tmp}/in/sub/b.csv", "w").write("x,y\n1,2\n")
    open(f"{tmp}/in/c.txt", "w").write("plain")
    files = tables.read_files(spark, f"{tmp}/in")
    got = {r.file_name: r.markdown for r in parse_documents(files).collect()}
    assert got == {"a.html": "# Hi\n\nthere", "b.csv": "| x | y |\n| --- | --- |\n| 1 | 2 |", "c.txt": "plain"}


def test_usage_ledger_and_missing_file(spark, tmp):
    doc = {"keys": {"wk-1": {"key": "wk-1", "usedCredits": 3, "lastChecked": "2024-01-02T03:04:05.000Z",
                             "remainingCredits": 7}}, "updatedAt": "x"}
    json.dump(doc, open(f"{tmp}/usage.json", "w"))
    r = tables.read_usage_ledger(spark, f"{tmp}/usage.json").first()
    assert (r.used_credits, r.remaining_credits, r.plan_credits) == (3, 7, None)
    assert str(r.last_checked).startswith("2024-01-02 03:04:05")
    assert tables.read_usage_ledger(spark, f"{tmp}/missing.json").count() == 0
    doc["keys"]["wk-1"]["lastChecked"] = " "
    json.dump(doc, open(f"{tmp}/blank.json", "w"))
    assert tables.read_usage_ledger(spark, f"{tmp}/blank.json").first().last_checked is None
    assert dict(tables.read_usage_ledger(spark, f"{tmp}/blank.json").dtypes)["last_checked"] == "timestamp_ntz"


def test_line_stores_read_the_time_forms_that_occur(spark, tmp):
    with open(f"{tmp}/cache.jsonl", "w") as f:
        for t in ("2024-01-02T03:04:05.678Z", "2024-01-02T03:04:05.678901", "2024-01-02T03:04:05Z", "", "soon"):
            f.write(json.dumps({"url": t or "none", "tool": "scrape", "timestamp": t, "credits": 1}) + "\n")
    got = {r.url: str(r.cached_at) for r in tables.read_cache_lines(spark, f"{tmp}/cache.jsonl").collect()}
    assert got == {
        "2024-01-02T03:04:05.678Z": "2024-01-02 03:04:05.678000", "2024-01-02T03:04:05.678901": "2024-01-02 03:04:05.678901",
        "2024-01-02T03:04:05Z": "2024-01-02 03:04:05", "none": "None", "soon": "None",
    }


def test_requests_cover_pages_and_keys_that_grow(spark):
    from webledger.sources.fixtures import Views

    seen = []
    for sf in ("0.001", "0.01"):
        v = Views(spark, f"/root/testdata/sf{sf}")
        pages, keys = v.requests.selectExpr("count(distinct page_id)", "count(distinct key_id)").first()
        assert pages == v.table("pages").count() and keys >= 0.9 * v.table("supplier").count()
        seen.append((pages, keys))
    assert seen[1][0] >= 4 * seen[0][0] and seen[1][1] >= 8 * seen[0][1]


def test_undecodable_files_and_quoted_cells(spark):
    rows = [("a.txt", "txt", bytearray(b"ok \xff")), ("b.csv", "csv", bytearray(b'name,"say ""hi"""\n"Doe, J",x\n"two\nlines",')),
            ("c.json", "json", bytearray(b"{}")), ("d.pdf", "pdf", bytearray(b"%PDF")), ("e.txt", "txt", None)]
    got = {r.file_name: (r.parsed, r.markdown) for r in S.parse_documents(
        spark.createDataFrame(rows, "file_name string, file_type string, content binary")).collect()}
    assert got["a.txt"] == (False, None) and got["d.pdf"] == (False, None) and got["e.txt"] == (False, None)
    assert got["b.csv"] == (True, '| name | say "hi" |\n| --- | --- |\n| Doe, J | x |\n| two lines |  |')
    assert got["c.json"] == (True, "```json\n{}\n```")


def test_parse_options(spark):
    html = b"<!DOCTYPE html><html><body><nav>menu</nav><article><h1>T</h1><p>text <a href='/x'>l</a></p></article></body></html>"
    df = spark.createDataFrame([("p.html", "html", bytearray(html))], "file_name string, file_type string, content binary")
    out = S.parse_documents(df, only_main_content=True, formats=F.array(F.lit("markdown"), F.lit("rawHtml"))).first()
    assert "menu" not in out.markdown and "# T" in out.markdown and out.raw_html == html.decode() and out.links is None
    out = S.parse_documents(df, exclude_tags=["nav"], formats=F.array(F.lit("html"))).first()
    assert "menu" not in out.html_out and out.markdown is None


def test_replayed_json_keys_and_null_bodies(spark):
    df = spark.createDataFrame([(1, '{"a":1,"a":2}'), (2, None)], "id int, body string")
    got = {r.id: (r.payload_kind, r.p) for r in payload.parse_payloads(df).select("id", "payload_kind", F.to_json("payload").alias("p")).collect()}
    assert got == {1: ("json", '{"a":2}'), 2: ("empty", "{}")}


def test_merging_a_cache_counts_writes_only(spark):
    from webledger.operators import cache

    w = spark.createDataFrame([("u", "scrape", "json", "2024-01-02 00:00:00", 1, 5)], "url string, tool string, format string, ts string, credits long, request_id long")
    w = w.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    old = cache.record_fetches(w.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY")).withColumn("credits", F.lit(6)))
    r = cache.record_fetches(w, old).first()
    assert (r.n_writes, r.credits_written, r.credits) == (1, 1, 1)


def test_url_cache_document(spark, tmp):
    doc = {"scraped": {"https://a": {"url": "https://a", "tool": "scrape", "format": "json",
                                     "timestamp": "2024-01-01T00:00:00.000Z", "credits": 5}},
           "totalCreditsUsed": 5, "monthlyBudget": 100, "updatedAt": "x"}
    json.dump(doc, open(f"{tmp}/cache.json", "w"))
    entries, totals = tables.read_url_cache(spark, f"{tmp}/cache.json")
    assert entries.first().credits == 5 and totals.first().monthly_budget == 100
    e, t = tables.read_url_cache(spark, f"{tmp}/none.json")
    assert e.count() == 0 and tuple(t.first()) == (0, 0)


def test_merge_latest_updates_win(spark):
    cur = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, t int, v int")
    upd = spark.createDataFrame([("a", 2, 11), ("c", 1, 30), ("b", 1, 21)], "k string, t int, v int")
    got = {r.k: r.v for r in payload.merge_latest(cur, upd, ["k"], ["t"]).collect()}
    assert got == {"a": 11, "b": 21, "c": 30}


def test_payload_kinds(spark):
    df = spark.createDataFrame([(1, '{"ok":true}'), (2, "not json"), (3, "")], "id int, body string")
    got = {r.id: (r.payload_kind, r.raw_text) for r in payload.parse_payloads(df).collect()}
    assert got == {1: ("json", None), 2: ("text", "not json"), 3: ("empty", None)}


def test_compact_params_drops_absent_keeps_array_slots(spark):
    df = spark.createDataFrame([(1,)], "id int")
    out = payload.compact_params(df, {"keep": F.lit(False), "drop": F.lit(None).cast("string"),
                                      "list": F.array(F.lit(None).cast("int"), F.lit(1))}).first()
    assert out.params_json == '{"keep":false,"list":[null,1]}'


def test_versions_survive_a_broken_write(spark, tmp):
    from webledger.sources.versions import VersionedTable

    schema = "k long, v string, t long"
    make = lambda rows: spark.createDataFrame(rows, schema)
    table = VersionedTable(spark, f"{tmp}/t", make([]).schema, keep=2)
    assert table.versions() == [] and table.read().collect() == []
    assert table.publish(make([(1, "a", 1), (2, "b", 1)])) == 1
    broken = make([(1, "x", 2), (3, "y", 2)]).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.publish(broken)
    assert table.versions() == [1] and {r.v for r in table.read().collect()} == {"a", "b"}
    held = table.read()  # a reader of version 1 while version 2 is published
    assert table.merge(make([(2, "c", 2), (4, "d", 2)]), ["k"], ["t"]) == 2
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "a"), (2, "c"), (4, "d")}
    assert {(r.k, r.v) for r in held.collect()} == {(1, "a"), (2, "b")} == {(r.k, r.v) for r in table.read(1).collect()}
    # Another object, or process, sees the same; old versions go by number.
    again = VersionedTable(spark, f"{tmp}/t", make([]).schema, keep=2)
    assert again.publish(make([])) == 3 and again.versions() == [2, 3] and again.read().count() == 0
    with pytest.raises(ValueError):
        again.read(1)
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{tmp}/t", make([]).schema, keep=0)
