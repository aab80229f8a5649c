"""Operators 11 to 13 against brute force on small tables with nulls, empty and
long texts, ties, repeated rows and further columns with clashing names."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webledger.llm import decontaminate, lexical, whitening, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, row long, n long, hash string, item_id long, start int, qb int"
ITEMS = "item_id long, text string, phrase string, term int, words int, doc_id long"


def split(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def documents():
    rng = np.random.default_rng(3)
    names = [f"{a}{b}" for a in ("ba", "ce", "dÉ", "fo", "ß") for b in ("x", "y7", "Z")]
    text = lambda n: " ".join(rng.choice(names, n))
    passage = "The quick brown fox jumps over the lazy dog and runs into the green wood near the river"
    texts = [
        (1, f"{text(30)} {passage}. {text(20)}"), (2, passage.upper().replace(" ", "--")), (3, None), (4, ""), (5, " \t.. \n"), (6, passage[:40]),
        (7, f"{passage} {passage}"), (7, f"{passage} {passage}"), (8, text(3000) + " " + passage + " " + text(50)), (None, passage + " end"), (9, "short item here"),
        (10, "a a a a a a a a a a a a a"), (11, "it is a short\nitem HERE now"), (12, passage.replace("lazy", "idle")), (13, "solo"),
        *((20 + i, text(40)) for i in range(30)), *((60 + i, "same words in every copy") for i in range(15)),
    ]
    return [(d, t, "en", 0, 0, "h", 1, 2, 3) for d, t in texts]


def items():
    passage = "the quick brown fox jumps over the lazy dog and runs into the green wood near the river"
    rng = np.random.default_rng(4)
    names = [f"{a}{b}" for a in ("ba", "ce", "dÉ", "fo", "ß") for b in ("x", "y7", "z")]
    texts = [
        (1, passage), (2, passage + " again"), (3, "short item here"), (4, None), (5, ""), (6, "a a a a a a a a a a a"), (7, "nowhere to be found at all in any of these documents, is it"),
        (8, "solo"), (9, "Same words in every copy"), (None, "every copy same"), (3, "and another short item"), (10, passage[:70]), *((20 + i, " ".join(rng.choice(names, 12))) for i in range(8)),
    ]
    return [(i, t, "p", 1, 2, 3) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(items(), ITEMS).repartition(2)


# Words -------------------------------------------------------------------


def test_words_are_those_of_the_pattern(spark):
    texts = [None, "Hello wörld it's 3", "", "abc", "ABC  x", "  ", "@[`{é~", "日本語 テスト𝒳a", "x"]
    for some in (pa.array(texts), pa.array(texts).slice(2, 4), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        distinct, codes, bounds = words.words_of(some)
        got = [[distinct[c].as_py() for c in codes[a:b].tolist()] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        assert got == [split(t) for t in some.to_pylist()]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(words.sql_words(F.col("text"))).collect()] == [split(t) for t in texts]


def test_filters_hold_all_hashes_and_few_others(spark):
    df = spark.range(5000).select(F.xxhash64(F.col("id").cast("string")).alias("hash"))
    bits = words.filter_of(df, bits=20)
    assert len(bits) == 1 << 14
    hashes = words.hashes_of(pa.array([str(i) for i in range(20_000)]))
    assert words.may_hold(bits, hashes[:5000]).all() and words.may_hold(bits, hashes[5000:]).mean() < 0.01


# Decontamination -----------------------------------------------------------


def brute_spans(rows, benchmark, window, shingle, containment):
    out = Counter()
    for d, t, *_ in rows:
        have = split(t)
        for i, text, *_ in benchmark:
            w = split(text)
            size = min(window, len(w))
            for phrase in {tuple(w[p : p + size]) for p in range(len(w) - size + 1)} if size else ():
                k = min(shingle, size)
                m = size - k + 1
                for s in range(len(have) - size + 1):
                    there = tuple(have[s : s + size])
                    agree = sum(there[j : j + k] == phrase[j : j + k] for j in range(m))
                    if agree >= max(1, math.ceil(containment * m - 1e-9)):
                        out[d, i, s, size, " ".join(phrase)] = 1
    return out


@pytest.mark.parametrize(("window", "shingle", "containment"), [(10, 5, 1.0), (10, 5, 0.5), (6, 2, 0.8), (4, 4, 1.0)])
def test_spans_are_those_of_brute_force(docs, bench, window, shingle, containment):
    got = {tuple(r) for r in decontaminate.spans(docs, bench, window, shingle, containment).collect()}
    assert got == set(brute_spans(documents(), items(), window, shingle, containment))


def test_contamination_of_each_row(docs, bench):
    want = Counter()
    for d, t, *_ in documents():
        found = brute_spans([(d, t)], items(), 10, 5, 1.0)
        hit = {k for _, _, s, size, _ in found for k in range(s, s + size)}
        ids = sorted({str(i) for _, i, *_ in found if i is not None})
        want[d, len(split(t)), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    got = Counter(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    assert got == want and any(k[5] for k in got) and any(not k[5] for k in got)


def test_only_the_rarest_shingles_are_looked_for(spark, docs, bench):
    windows = decontaminate.windows_of(bench, 10, 5)
    phrases = windows.groupBy("phrase").agg(F.first("words").alias("words"), F.first("length").alias("length"), F.first("shingles").alias("shingles")).withColumn("phrase_id", F.monotonically_increasing_id()).cache()
    rarity = decontaminate.counted(docs, phrases.select(F.explode("shingles").alias("hash")).distinct(), [1, 3, 5])
    frequency = {r["hash"]: r["n"] for r in rarity.collect()}
    of = {r["phrase_id"]: r for r in phrases.collect()}
    chosen = decontaminate.prefixes_of(phrases, rarity, 1.0).collect()
    assert len({r["phrase_id"] for r in chosen}) == len(chosen)
    for r in chosen:
        assert frequency[r["hash"]] == min(frequency[s] for s in of[r["phrase_id"]]["shingles"]) > 0
    # Windows with a shingle that no document has are dropped beforehand.
    assert not any("nowhere" in of[r["phrase_id"]]["words"] for r in chosen)


def test_empty_tables_give_no_rows_or_no_hits(spark, docs, bench):
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    got = decontaminate.contaminated(docs, bench.limit(0)).collect()
    assert len(got) == len(documents()) and not any(r["contaminated"] or r["n_items"] for r in got)
    assert lexical.ranked(docs.limit(0), bench).collect() == [] and lexical.ranked(docs, bench.limit(0)).collect() == []


# Lexical search --------------------------------------------------------------


def brute_ranks(rows, benchmark, k):
    have = [(d, split(t)) for d, t, *_ in rows if split(t)]
    n, length = len(have), sum(len(w) for _, w in have)
    df = Counter(t for _, w in have for t in set(w))
    query = defaultdict(Counter)
    for i, t, *_ in benchmark:
        query[i].update(split(t))
    out = []
    for i, terms in query.items():
        scored = []
        for d, w in have:
            tf, m = Counter(w), 25 + (75 * len(w) * n) // length
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t, q in terms.items() if tf[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d, s))
        out += [(i, r, d, s) for r, (*_, d, s) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize(("k", "documents_of_block", "terms_of_block"), [(10, 4096, 50_000), (3, 7, 20)])
def test_ranks_are_those_of_brute_force(docs, bench, k, documents_of_block, terms_of_block):
    got = Counter(map(tuple, lexical.ranked(docs, bench, k, documents_of_block, terms_of_block).collect()))
    assert got == brute_ranks(documents(), items(), k)


def test_shared_sums_share_and_keep_every_item():
    rng = np.random.default_rng(5)
    common = np.arange(0, 12)
    items_ = [np.unique(np.concatenate((common[: rng.integers(4, 13)], rng.choice(200, 8) + 12))) for _ in range(40)]
    items_ += [items_[0], np.zeros(0, np.int64), np.array([3])]
    rounds, rest, nodes = lexical.shared_sums(items_)
    leaves = 1 + max(int(i.max()) for i in items_ if len(i))
    held = {i: Counter([i]) for i in range(leaves)}
    for r in rounds:
        for node, left, right in r.T.tolist():
            held[node] = held[left] + held[right]
    assert len(held) == nodes
    for item, left in zip(items_, rest, strict=True):
        assert sum((held[i] for i in left.tolist()), Counter()) == Counter(item.tolist())
    additions = nodes - leaves + sum(max(0, len(r) - 1) for r in rest)
    assert additions < 0.75 * sum(max(0, len(i) - 1) for i in items_)


def test_scores_do_not_depend_on_the_cells_held_at_a_time(docs, bench):
    rng = np.random.default_rng(6)
    plan = lexical.plan_of(pa.table({"qb": [0] * 9, "item_id": [1, 1, 1, 2, 2, 2, 3, 3, 3], "term": list("abcabcabd"), "times": [1, 1, 1, 1, 1, 2, 1, 1, 1], "weight": [5, 6, 7, 5, 6, 7, 5, 6, 9]})).drop_columns(["qb"]).to_pylist()[0]
    of = [sorted(set(rng.choice(list("abcde"), 3).tolist())) for _ in range(50)]
    table = pa.table({"row": range(50), "doc_id": range(50), "m": rng.integers(25, 200, 50), "terms": of, "counts": pa.array([[int(rng.integers(1, 4)) for _ in t] for t in of], pa.list_(pa.int64()))})
    whole = sorted(zip(*(x.tolist() for x in lexical.block_scores(plan, table, 50)), strict=True))
    for cells in (1, 60):
        assert sorted(zip(*(x.tolist() for x in lexical.block_scores(plan, table, 50, cells)), strict=True)) == whole


# Whitening ---------------------------------------------------------------------


def brute_white(vectors, k=4):
    fit = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors})
    x, n = np.array(fit, float), len(fit)
    s = [sum(v[i] for v in fit) for i in range(len(fit[0]))]
    centred = x - np.array(s) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    z = centred @ axes[:, order] / np.sqrt(values[order])
    return n, {v: (sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), z[i]) for i, v in enumerate(fit)}, values[order] / values.sum()


def test_whitening_is_that_of_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 16)
    monkeypatch.setattr(whitening, "SLAB", 64)
    rng = np.random.default_rng(7)
    base = (rng.normal(size=(150, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(200 + i, base[0].tolist()) for i in range(70)] + [(None, base[1].tolist()), (3, base[3].tolist())]
    bad = [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad], "vec_id long, embedding array<float>, index int, x int").repartition(5)
    got = whitening.whitened(df).collect()
    n, of, explained = brute_white([v for _, v in rows])
    assert len(got) == 4 * len(rows) and {r["n"] for r in got} == {n}
    want = Counter((i, c, of[tuple(math.floor(256 * float(x)) for x in v)][0]) for i, v in rows for c in (1, 2, 3, 4))
    assert Counter((r["vec_id"], r["component"], r["deviation"]) for r in got) == want
    by = {i: of[tuple(math.floor(256 * float(x)) for x in v)][1] for i, v in rows}
    for c in (1, 2, 3, 4):
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c}
        sign = np.sign(mine[0]) * np.sign(by[0][c - 1])
        assert all(abs(sign * w - by[i][c - 1]) < 1e-9 for i, w in mine.items())
        assert all(abs(r["explained"] - explained[c - 1]) < 1e-9 for r in got if r["component"] == c)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_of_few_or_degenerate_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whitened(make([])).collect() == [] and whitening.whitened(make([(1, None)])).collect() == []
    assert whitening.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no variance at all
    got = whitening.whitened(make([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, [1.0])])).collect()  # [1] is [1, 0]
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {3}
    line = whitening.whitened(make([(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [4.0, 4.0])])).collect()
    assert {r["component"] for r in line} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in line)
    huge = whitening.whitened(make([(1, [3e30, 1.0]), (2, [-3e30, 2.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) >= 3 and all(r["deviation"] is None for r in huge if r["vec_id"] in (1, 2))
