"""Benchmark decontamination by a prefix-filtered set join (operator 11).

An item's words are cut into windows of a fixed size (an item of fewer words
is one window), a window into shingles of consecutive words.  A document
window holds an item's window if, laid on it, at least the share
``containment`` of the shingles agree, place by place (1, the default: all
of them, that is, word by word).

- Shingles are ordered by rarity: how often each of them occurs in all
  documents.  If ``need`` of a window's m shingles must agree, one of its
  m - need + 1 rarest does.  Only this prefix is looked for, and a window with
  fewer than ``need`` shingles that occur at all is dropped.
- Documents are read by tasks that hold a filter of fixed size over the
  prefixes' hashes.  A shingle that passes goes on with the words around it,
  and is joined with the prefixes.
- Position and length: the window's place follows from the shingle's place in
  both; it has to lie inside the document.
- What is left is compared word by word, so no hash is trusted.

Input cases: a null or empty text has no words; an item without words has no
windows; items with equal windows share them; rows that repeat an item_id are
one item with the windows of all; an item without item_id marks words, but is
neither counted nor listed; every row of the documents is judged by itself,
also if a doc_id is repeated or null; an empty table of documents gives no
rows, an empty one of items no hits; further columns are ignored.  Texts of
any length are read whole (a task holds about ten times its longest text).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webledger.llm.common import splittable, table, with_python, written
from webledger.llm.words import filter_of, hashes_of, lists, may_hold, portions, row_numbers, words_of

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive word hashes; other lengths give other hashes."""
    out = np.full(max(0, len(words) - length + 1), length, np.uint64)
    for i in range(length):
        out = (out ^ words[i : i + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return out


def windows_of(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, phrase, words, length (of its shingles), shingles: the windows of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            distinct, codes, bounds = words_of(batch.column("text"))
            names, hashes = distinct.to_pylist(), hashes_of(distinct)
            for item, a, b in zip(batch.column("item_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                size, length = min(window, b - a), min(shingle, b - a)
                if not size:
                    continue
                word, found = [names[c] for c in codes[a:b].tolist()], shingle_hashes(hashes[codes[a:b]], length).view(np.int64).tolist()
                places = range(b - a - size + 1)
                for at in range(0, len(places), 1000):
                    some = places[at : at + 1000]
                    yield pa.record_batch({
                        "item_id": pa.array([item] * len(some), pa.int64()), "phrase": [" ".join(word[p : p + size]) for p in some], "words": [word[p : p + size] for p in some],
                        "length": pa.array([length] * len(some), pa.int32()), "shingles": [found[p : p + size - length + 1] for p in some],
                    })

    few = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return with_python(few).mapInArrow(cut, "item_id long, phrase string, words array<string>, length int, shingles array<long>")


def counted(texts: DataFrame, wanted: DataFrame, lengths: list[int]) -> DataFrame:
    """hash, n: how often each of the shingles ``wanted`` (hash) occurs in all texts."""
    passes = texts.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            distinct, codes, bounds = words_of(batch.column("text"))
            words = hashes_of(distinct)[codes]
            for length in lengths:
                found = shingle_hashes(words, length)
                found = found[may_hold(passes.value, found) & inside(bounds, length)]
                each, n = np.unique(found, return_counts=True)
                yield pa.record_batch({"hash": each.view(np.int64), "n": n.astype(np.int64)})

    sums = with_python(texts.select(F.col("text").cast("string"))).mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return wanted.join(sums, "hash", "left").select("hash", F.coalesce("n", F.lit(0)).alias("n"))


def inside(bounds: np.ndarray, length: int) -> np.ndarray:
    """Of all runs of ``length`` words, those within one text."""
    ok = np.ones(max(0, int(bounds[-1]) - length + 1), bool)
    for back in range(1, length):
        at = bounds[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def prefixes_of(phrases: DataFrame, rarity: DataFrame, containment: float) -> DataFrame:
    """phrase_id, offset, hash, words, length, need: each window's rarest
    shingles, as many as make sure that a document window which holds it has one of them."""
    need = F.greatest(F.lit(1), F.ceil(F.size("shingles") * F.lit(containment) - F.lit(1e-9))).cast("int")
    each = phrases.select("phrase_id", "words", "length", need.alias("need"), F.size("shingles").alias("m"), F.posexplode("shingles").alias("offset", "hash"))
    ordered = each.join(rarity, "hash").withColumn("place", F.row_number().over(Window.partitionBy("phrase_id").orderBy(F.desc("n"), "hash", "offset")))
    # From the most frequent on: places from ``need`` on are the m - need + 1 rarest.
    some = ordered.withColumn("occur", F.sum((F.col("n") > 0).cast("int")).over(Window.partitionBy("phrase_id")))
    return some.where("place >= need and occur >= need and n > 0").select("phrase_id", "offset", "hash", "words", "length", "need", "m")


def hits_in(docs: DataFrame, prefixes: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """For each row of ``docs`` its row number, doc_id and n_words; besides, for
    each shingle that passes the prefixes' filter: row, hash, pos, and the words around it, of which ``before`` precede it."""
    passes = docs.sparkSession.sparkContext.broadcast(filter_of(prefixes.select("hash").distinct()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in portions(batches):
            distinct, codes, bounds = words_of(batch.column("text"))
            rows = row_numbers(seen, batch.num_rows)
            seen += batch.num_rows
            yield batch_of(row=rows, doc_id=batch.column("doc_id"), n_words=np.diff(bounds))
            words = hashes_of(distinct)[codes]
            for length in lengths:
                found = shingle_hashes(words, length)
                every = np.flatnonzero(may_hold(passes.value, found) & inside(bounds, length))
                for at in (every[i : i + 20_000] for i in range(0, len(every), 20_000)):
                    doc = np.searchsorted(bounds, at, side="right") - 1
                    low = np.maximum(bounds[doc], at - (window - length))
                    high = np.minimum(bounds[doc + 1], at + window)
                    n = high - low
                    around = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                    yield batch_of(
                        row=rows[doc], hash=found[at].view(np.int64), pos=at - bounds[doc], before=(at - low).astype(np.int32),
                        around=lists(distinct.take(pa.array(codes[around])).cast(pa.string()), n),
                    )

    fields = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hash", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("around", pa.list_(pa.string()))])

    def batch_of(**columns) -> pa.RecordBatch:
        n = len(columns["row"])
        return pa.record_batch([pa.array(columns[f.name], f.type) if isinstance(columns.get(f.name), np.ndarray) else columns.get(f.name, pa.nulls(n, f.type)) for f in fields], schema=fields)

    few = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_python(few).mapInArrow(find, "row long, doc_id long, n_words long, hash long, pos long, before int, around array<string>")


def contained(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, found, owners): ``rows`` has row, doc_id and n_words of each
    document; ``found`` has row, start, size and phrase_id of each document
    window that holds an item's window; ``owners`` has phrase_id, phrase and item_id."""
    windows = written(windows_of(items, window, shingle), "windows")
    distinct = windows.groupBy("phrase").agg(F.first("words").alias("words"), F.first("length").alias("length"), F.first("shingles").alias("shingles"))
    phrases = written(distinct.withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    owners = windows.select("item_id", "phrase").distinct().join(phrases.select("phrase", "phrase_id"), "phrase").select("phrase_id", "phrase", "item_id")
    lengths = sorted(r[0] for r in phrases.select("length").distinct().collect())  # at most ``shingle`` of them

    wanted = phrases.select(F.explode("shingles").alias("hash")).distinct()
    prefixes = written(prefixes_of(phrases, counted(docs, wanted, lengths), containment), "prefixes")
    scanned = written(hits_in(docs, prefixes, lengths, window), "hits")

    p = prefixes.select("phrase_id", "offset", F.col("hash").alias("of_hash"), "words", "length", "need", "m")
    near = scanned.where("hash is not null").join(p, F.col("hash") == F.col("of_hash"))
    first = F.col("before") - F.col("offset")  # the window's place among the words around
    near = near.where((first >= 0) & (first + F.size("words") <= F.size("around"))).select(
        "row", (F.col("pos") - F.col("offset")).alias("start"), F.size("words").alias("size"), "phrase_id", "words", "length", "need", "m",
        F.slice("around", first + 1, F.size("words")).alias("there"),
    )
    agree = F.size(F.filter(F.sequence(F.lit(1), F.col("m")), lambda i: F.slice("words", i, F.col("length")) == F.slice("there", i, F.col("length"))))
    holds = F.when(F.col("need") == F.col("m"), F.col("words") == F.col("there")).otherwise(agree >= F.col("need"))
    found = near.where(holds).select("row", "start", "size", "phrase_id")
    if containment < 1:  # a window can be found by several shingles of its prefix
        found = found.distinct()
    return scanned.where("n_words is not null").select("row", "doc_id", "n_words"), written(found, "found"), owners


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    rows, found, owners = contained(docs, items, window, shingle, containment)
    # Words inside any window found: each window adds what lies beyond all that start before it.
    end = F.col("start") + F.col("size")
    reached = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        found.select("row", "start", end.alias("end")).distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0)))))
        .groupBy("row").agg(F.sum("new").alias("n_hit"))
    )
    of = owners.select(splittable("phrase_id").alias("of_phrase"), "item_id")
    held = (
        found.select("row", "phrase_id").distinct().join(of, splittable("phrase_id") == F.col("of_phrase")).where("item_id is not null")
        .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_held = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(covered, "row", "left").join(held, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_held).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_held, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0) -> DataFrame:
    """doc_id, item_id, start, size, phrase: the document windows (in words) that hold an item's window."""
    rows, found, owners = contained(docs, items, window, shingle, containment)
    of = owners.withColumn("of_phrase", splittable("phrase_id")).drop("phrase_id")
    return found.join(of, splittable("phrase_id") == F.col("of_phrase")).join(rows, "row").select("doc_id", "item_id", "start", "size", "phrase")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: DuckDB text of op11.
OP11_SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), p as (
  select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as phrase
  from (select item_id, w, least(10, len(w)) as size, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)
), h as (
  select r, item_id, i, x.size from (
    select r, s.size, i, array_to_string(w[i : i + s.size - 1], ' ') as phrase
    from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from d, (select distinct size from p) where len(w) >= size) s
  ) x join p on p.size = x.size and p.phrase = x.phrase
), hit as (
  select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + size)) as k from h) group by r
), held as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, cast(item_id as varchar) as id from h where item_id is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join held using (r)
"""
