"""The corpus pipeline against a plain version of its stages, and the
registered queries of the subpackage on the small given tables."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from webledger.llm import queries, secrets

EN = "the quick brown fox jumps over the lazy dog and runs into the green wood near the river".split()
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft in den grünen Wald am Fluss".split()


def documents():
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(rng.choice((EN, DE)[i % 2], 60)), ("en", "de")[i % 2]) for i in range(120)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(10)]  # exact copies
    rows += [(300 + i, rows[i][1].replace(" ", "  ", 3), None) for i in range(5)]  # but for white space
    long = " ".join(rng.choice(EN, 4000))
    rows += [(400, long, "en"), (401, long + " end", "en"), (402, "start " + long, None)]  # near copies
    rows += [(500, None, "en"), (501, "", None), (502, "12 34 .. !", "en"), (None, " ".join(DE), None)]
    rows += [(600, " ".join(EN) + ' password = "hunter2hunter2" ' + " ".join(EN[::-1]), "en")]
    return [(d, t, lang, "s", len(t or ""), "x") for d, t, lang in rows]


def fingerprint(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) if x]
    h = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stages_keep_what_they_should(spark, tmp_path):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept_id string")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [(d, t) for d, t, *_ in rows if t and re.search(r"[^\W\d_]", t)]  # the language stage rejects the rest
    first = {}
    for d, t in sorted(left, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (d, t))
    fps = {d: fingerprint(t) for d, t in first.values() if d is not None}
    root = {d: d for d in fps}
    for a in sorted(fps):
        for b in sorted(fps):
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    final = {d: secrets.redacted(t, secrets.spans(t)) for d, t in first.values() if d is None or root[d] == d}
    assert "hunter2" not in final[600] and 401 not in final and 402 not in final and len(final) == 123

    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = Counter()
    for d, text in final.items():
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            some = np.array(ids[s : s + 2048], "<u4")
            want[d, s, len(some), zlib.crc32(some.tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in packed) == want


def test_stages_return_the_columns_of_documents(spark):
    df = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long, kept_id string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns
        assert stage(spark, df.limit(0), "").count() == 0


@pytest.mark.parametrize("stage", [corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup])
def test_copies_go_by_row_not_by_doc_id(spark, stage):
    rng = np.random.default_rng(12)
    a, b, c, d, e = (" ".join(rng.choice(EN + DE, 300)) for _ in "abcde")
    rows = [(1, a, 1), (1, b, 2), (2, a, 3), (2, c, 4), (3, d, 5), (3, d, 6), (None, a, 7), (None, e, 8), (None, e, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank int").repartition(3)
    got = stage(spark, df, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(1, a), (1, b), (2, c), (3, d), (0, e)])


def test_block_naming_sends_no_text_to_the_driver(spark):
    """Names are dealt by hash: no range sort, whose samples are whole blocks."""
    from webledger.llm import naming
    from webledger.llm.common import Scratch

    seen = []
    with Scratch(spark) as keep:
        write = keep.written
        keep.written = lambda df, label: seen.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label)
        naming.document_names(spark.createDataFrame([(1, "aaaabbbbcc"), (2, "aaaabbbbcc")], "row long, norm string"), keep, 4).collect()
    assert len(seen) > 3 and not any("rangepartitioning" in p for p in seen)


def test_registered_names():
    import __spark_entry__ as e

    named = [q for q in e.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in named) == list(range(1, 14))
    assert "pipeline" in e.queries() and set(queries.ORACLES) <= set(e.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, sf, name):
    import duckdb

    df = queries.QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    if name in queries.ORACLES:
        cur = con.execute(queries.ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        at = [df.columns.index(c) for c in names]
        assert Counter(tuple(r[i] for i in at) for r in rows) == Counter(cur.fetchall())
    else:
        table = {"op2": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
        assert len({r[0] for r in rows}) == con.execute(f"select count(*) from {table}").fetchone()[0]
