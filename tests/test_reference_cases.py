"""The reference's own literal cases (FIXTURES.md part A) as column tests."""

from pyspark.sql import functions as F

from webledger.functions.urls import trim_url
from webledger.operators import cost, payload, sets


def test_url_trimming(spark):
    df = spark.createDataFrame([(" https://example.test/v1/// ",), ("   ",)], "u string")
    got = [r.t for r in df.select(trim_url(F.col("u")).alias("t")).collect()]
    assert got == ["https://example.test/v1", None]  # blank falls back to the default


def test_tool_selection_normalisation(spark):
    df = spark.createDataFrame([(["search", "scrape", "search"],), (["bad"],)], "tools array<string>")
    known = F.array(*[F.lit(t) for t in cost.TOOL_ORDER])
    out = df.select(
        sets.order_selection(F.col("tools")).alias("ordered"),
        F.forall("tools", lambda t: F.array_contains(known, t)).alias("valid"),
    ).collect()
    assert out[0].ordered == ["scrape", "search"] and out[0].valid
    assert not out[1].valid  # rejected


def test_merge_keeps_first_seen_order(spark):
    df = spark.createDataFrame([(["bash", "search"], ["scrape", "search"])], "a array<string>, b array<string>")
    assert df.select(sets.merge_selections(F.col("a"), F.col("b")).alias("m")).first().m == ["bash", "search", "scrape"]


def test_cleaning_drops_absent_keeps_null_slots(spark):
    # {keep:false, drop:undefined, nested:{drop:undefined, value:null}, list:[undefined,1]}
    df = spark.createDataFrame([(1,)], "id int")
    fields = {
        "keep": F.lit(False),
        "drop": F.lit(None).cast("string"),  # absent
        "nested": F.struct(F.lit(None).cast("string").alias("drop"), payload.explicit_null().alias("value")),
        "list": F.array(F.lit(None).cast("int"), F.lit(1)),
    }
    out = payload.compact_params(df, fields).first().params_json
    assert out == '{"keep":false,"nested":{"value":null},"list":[null,1]}'


def test_response_bodies(spark):
    df = spark.createDataFrame([('{"ok":true}',), ("not json",)], "body string")
    out = payload.parse_payloads(df).select("payload_kind", "raw_text",
                                            F.expr("try_variant_get(payload, '$.ok', 'boolean')").alias("ok")).collect()
    assert (out[0].payload_kind, out[0].ok) == ("json", True)
    assert (out[1].payload_kind, out[1].raw_text) == ("text", "not json")


def test_encode_component_matches_encode_uri_component(spark):
    from webledger.functions.urls import encode_component

    df = spark.createDataFrame([("m-Customer#000000001 a*b~c!d'e(f)g/h+i",)], "x string")
    assert df.select(encode_component(F.col("x"))).first()[0] == "m-Customer%23000000001%20a*b~c!d'e(f)g%2Fh%2Bi"


def test_request_paths_skip_zero_limit_and_offset(spark):
    calls = spark.createDataFrame(
        [("a", "monitor_list", None, 0, 0), ("b", "monitor_list", None, 25, 5), ("c", "monitor_checks", "x y", None, 2),
         ("d", "crawl_status", "job/1", None, None), ("e", "scrape", None, None, None)],
        "call_id string, tool string, id string, limit int, offset int",
    )
    got = {r.call_id: r.path for r in payload.request_paths(calls).collect()}
    assert got == {"a": "/monitor", "b": "/monitor?limit=25&offset=5", "c": "/monitor/x%20y/checks?offset=2",
                   "d": "/crawl/job%2F1", "e": "/scrape"}


def test_url_overlap_set_operations(spark):
    a = spark.createDataFrame([("u1",), ("u2",), ("u2",), ("u3",)], "url string")
    b = spark.createDataFrame([("u2",), ("u4",)], "url string")
    got = {how: sorted(r.url for r in sets.url_overlap(a, b, how).collect())
           for how in ("both", "only_a", "only_b", "either")}
    assert got == {"both": ["u2"], "only_a": ["u1", "u3"], "only_b": ["u4"], "either": ["u1", "u2", "u3", "u4"]}


def test_search_changes_between_runs(spark):
    from webledger.operators import monitor

    prev = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "query_id long, doc_id long")
    curr = spark.createDataFrame([(1, 11), (1, 12), (2, 20)], "query_id long, doc_id long")
    got = sorted((r.query_id, r.doc_id, r.change) for r in monitor.search_changes(prev, curr).collect())
    assert got == [(1, 10, "left"), (1, 12, "entered")]


def test_set_budget_replaces_only_updated_accounts(spark):
    acc = spark.createDataFrame([(1, 100), (2, 200)], "account_id long, monthly_budget long")
    upd = spark.createDataFrame([(2, 500)], "account_id long, monthly_budget long")
    got = {r.account_id: r.monthly_budget for r in cost.set_budget(acc, upd).collect()}
    assert got == {1: 100, 2: 500}
    upd = spark.createDataFrame([(2, 500, 1), (2, 300, 2), (7, 50, 1)], "account_id long, monthly_budget long, updated_at int")
    got = sorted((r.account_id, r.monthly_budget) for r in cost.set_budget(acc, upd).collect())
    assert got == [(1, 100), (2, 300), (7, 50)]  # the last update counts, a new account is added
