"""Line dedup (operator 1): sharded cuckoo filters over exact reference-count tables.

``LineStore`` keeps three tables in a folder, each dealt by shard (a residue of
the key hash), with the shards gathered in at most ``PARTS`` folders:

- ``postings``: (shard, hi, lo, doc_id), which documents hold a key;
- ``counts``: (shard, hi, lo, n_docs, keeper), the exact reference counts and
  the smallest doc_id of each key;
- ``filters``: (shard, cells), a cuckoo filter over the shard's keys that two
  or more documents hold.

A key (128-bit hash of the line key) enters its shard's filter when its count
reaches two and leaves it when the count falls below two, so the store can take
documents in and out again and ends as if they had never been there.  A change
writes the parts anew that hold one of its keys, and no others.  Which folder
holds a part is a short manifest, published last: a write that breaks off
leaves the store as it was, and a store is opened again by its path.  Unless
given, the number of shards follows from the number of lines, and the store is
dealt anew when it has grown to twice that.

To clean documents, lines are first looked up in the filters: a miss can't be a
shared line and goes no further; a hit is settled by the exact table.  Filters
of up to ``FILTER_BYTES`` together are sent to every task.  Larger ones stay
where they are: the lines are dealt by shard and meet their shard's filter in a
task that holds one filter at a time; keys so frequent that one of them could
fill a task (at most ``HOT`` of them) are known to be shared and need no look-up.

Input cases: a null or empty text is one empty line; keys of under
``min_chars`` code points are never dropped; a line repeated within one
document counts once; rows that repeat a doc_id are one document for the
counts, and each row is cleaned; a null doc_id is cleaned, but keeps nothing
from others; an empty table gives an empty store; further columns are ignored.
A change deletes the parts it replaced, so read what ``clean`` gave before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webledger.llm.common import Scratch, scratch_path, slices, splittable, table, with_python
from webledger.llm.cuckoo import CuckooFilter
from webledger.session import delete_folder
from webledger.sources.versions import VersionedTable

MIN_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"
#: Filters of up to this size together are sent to every task.
FILTER_BYTES = 32 << 20
#: Lines of a shard, about, and the most folders that shards are gathered in.
SHARD_KEYS, PARTS = 200_000, 256
#: A key is hot from this part of all postings on, so there are at most so many.
HOT = 10_000
KEYS = ["shard", "hi", "lo"]
#: The store's tables; each is written with a column ``part`` beside these.
TABLES = {
    "postings": "shard long, hi long, lo long, doc_id long",
    "counts": "shard long, hi long, lo long, n_docs long, keeper long",
    "filters": "shard long, cells binary",
}
#: Where a part lies; ``lines`` taken in so far, null if the number of shards was given.
MANIFEST = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("shards", T.LongType()),
    T.StructField("min_chars", T.LongType()), T.StructField("lines", T.LongType()),
])


def line_keys(text: str | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the 128-bit hash of each one's key; None for a key that is too short."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    lines = raw.split(b"\n")
    keys = [x.strip(SPACE).lower() for x in lines]
    long = [len(k) >= 4 * min_chars or len(k.decode("utf-8", "surrogatepass")) >= min_chars for k in keys]
    return lines, [xxhash.xxh3_128_digest(k) if ok else None for k, ok in zip(keys, long, strict=True)]


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def shard_of(shards: int) -> Column:
    """The shard of a key with the first half ``hi``."""
    return F.pmod(F.shiftrightunsigned("hi", 20), F.lit(shards).cast("long"))


def distinct_keys(docs: DataFrame, shards: int, min_chars: int = MIN_CHARS, look_up: list[bytes] | None = None,
                  hot: list[bytes] | None = None) -> DataFrame:
    """(shard, hi, lo, doc_id, is_hot) of the distinct line keys of each
    document; with ``look_up``, the filters of all shards, only keys that may be shared."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((look_up, frozenset(hot or [])))
    names = ["hi", "lo", "doc_id", "is_hot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, frequent = sent.value
        filters = None if cells is None else [CuckooFilter.loads(x) if x else None for x in cells]
        for batch in slices(batches):
            docs_of, digests = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {d for d in line_keys(text, min_chars)[1] if d}
                digests += own
                docs_of += [doc] * len(own)
            if not digests:
                continue
            hi, lo = halves(digests)
            keep = np.ones(len(hi), bool)
            if filters is not None:
                shard = ((hi.astype(np.uint64) >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in np.unique(shard):
                    at = order[edges[s] : edges[s + 1]]
                    keep[at] = filters[s].contains(lo[at].astype(np.uint64)) if filters[s] is not None else False
            is_hot = pa.array([d in frequent for d in digests] if frequent else np.zeros(len(hi), bool))
            yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(docs_of, pa.int64()), is_hot], names).filter(pa.array(keep))

    found = with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return found.mapInArrow(run, "hi long, lo long, doc_id long, is_hot boolean").withColumn("shard", shard_of(shards))


def met_filters(keys: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The rows of ``keys`` (shard, hi, lo, doc_id, is_hot) that are hot or that
    their shard's filter may hold.  Rows are dealt by shard, the filter first;
    hot keys are dealt by document and pass."""
    spread = -1 - F.pmod(F.xxhash64("doc_id"), F.lit(shards).cast("long"))
    rows = keys.select(
        F.when(F.col("is_hot"), spread).otherwise(F.col("shard")).alias("place"), *KEYS, "doc_id", F.lit(None).cast("binary").alias("cells")
    ).unionByName(filters.select(F.col("shard").alias("place"), "shard", "cells"), allowMissingColumns=True)
    names = [*KEYS, "doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, None
        for batch in batches:
            place = batch.column("place").to_numpy()
            cells = batch.column("cells")
            known = cells.is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if place[start] != here:
                    here, held = place[start], None
                if known[start]:
                    held = CuckooFilter.loads(cells[start].as_py())
                    start += 1
                part = batch.slice(start, end - start).select(names)
                if here < 0:
                    yield part
                elif held is not None and part.num_rows:
                    yield part.filter(pa.array(held.contains(part.column("lo").to_numpy(zero_copy_only=False).astype(np.uint64))))

    dealt = rows.repartition("place").sortWithinPartitions("place", F.col("cells").isNull())
    return with_python(dealt).mapInArrow(run, TABLES["postings"])


def new_filters(now: DataFrame) -> DataFrame:
    """A filter for each shard of the keys ``now``."""
    import pandas as pd

    def made(keys: pd.DataFrame) -> pd.DataFrame:
        cells = CuckooFilter.of(keys["lo"].to_numpy(np.int64).astype(np.uint64)).dumps()
        return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "cells": [cells]})

    return with_python(now).groupBy("shard").applyInPandas(made, TABLES["filters"])


def changed_filters(filters: DataFrame, changes: DataFrame, now: DataFrame) -> DataFrame:
    """The filters after keys were put in (1) or taken out (-1).  A filter
    without room is made anew from the shard's keys, ``now``."""
    import pandas as pd

    def update(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else new)["shard"].iloc[0])
        keys = new["lo"].to_numpy(np.int64).astype(np.uint64)
        change = new["change"].to_numpy()
        here = CuckooFilter.loads(old["cells"].iloc[0]) if len(old) else CuckooFilter.of(np.zeros(0, np.uint64))
        here.delete(keys[change < 0])
        if not here.insert(keys[change > 0]):
            here = CuckooFilter.of(keys[change == 0])
        return pd.DataFrame({"shard": [shard], "cells": [here.dumps()]})

    both = changes.select("shard", "lo", "change").unionByName(now.select("shard", "lo", F.lit(0).alias("change")))
    return with_python(filters).groupBy("shard").cogroup(both.groupBy("shard")).applyInPandas(update, TABLES["filters"])


class LineStore:
    """Reversible line dedup over documents that come and go.  ``path`` of a
    store that is there opens it, with its number of shards; one writer at a time changes it."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int | None = None, min_chars: int = MIN_CHARS):
        self.spark, self.given, self.min_chars = spark, shards, min_chars
        self.path = (path or scratch_path(spark, "line-store")).rstrip("/")
        self.manifest = VersionedTable(spark, f"{self.path}/manifest", MANIFEST, keep=1)
        self.refresh()

    def refresh(self) -> None:
        """What the manifest says now: a row for each part, ``PARTS`` at most."""
        rows = self.manifest.read().collect()
        if rows and rows[0]["min_chars"] != self.min_chars:
            raise ValueError(f"the store was made with min_chars={rows[0]['min_chars']}")
        self.parts = {r["part"]: r["folder"] for r in rows}
        self.shards = rows[0]["shards"] if rows else self.given or 1
        self.lines = rows[0]["lines"] if rows else None if self.given else 0

    def read(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """A table of the store, or some parts of it."""
        of: dict[str, list[int]] = {}
        for part, folder in self.parts.items():
            if parts is None or part in parts:
                of.setdefault(folder, []).append(part)
        out = self.spark.createDataFrame([], TABLES[name])
        for folder, own in of.items():
            stored = self.spark.read.schema(TABLES[name] + ", part long").parquet(f"{self.path}/{folder}/{name}")
            out = out.unionByName(stored.where(F.col("part").isin(own)).drop("part"))
        return out

    def write(self, postings: DataFrame, parts: list[int], shards: int, lines: int | None) -> None:
        """``postings`` become the whole content of ``parts``; the folders they had before go when the manifest names the new one."""
        folder = f"data-{uuid.uuid4().hex}"
        afresh = shards != self.shards or not self.parts
        part = F.pmod("shard", F.lit(PARTS).cast("long"))

        def stored(df: DataFrame, name: str) -> DataFrame:
            # Parts are gathered, and a large one is split, by the sizes Spark measures.
            df.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.path}/{folder}/{name}")
            return self.spark.read.schema(TABLES[name] + ", part long").parquet(f"{self.path}/{folder}/{name}").drop("part")

        held = stored(postings.select(*KEYS, "doc_id").distinct(), "postings")
        counts = stored(held.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("keeper")), "counts")
        now = counts.where("n_docs > 1").select(*KEYS)
        if afresh:
            filters = new_filters(now)
        else:
            was = self.read("counts", parts).where("n_docs > 1").select(*KEYS)
            changes = now.join(was, KEYS, "left_anti").withColumn("change", F.lit(1)).unionByName(was.join(now, KEYS, "left_anti").withColumn("change", F.lit(-1)))
            filters = changed_filters(self.read("filters", parts), changes, now)
        stored(filters, "filters")
        before = self.parts
        after = {**({} if afresh else before), **dict.fromkeys(parts, folder)}
        rows = [(p, f, shards, self.min_chars, lines) for p, f in after.items()]
        self.manifest.publish(self.spark.createDataFrame(rows, MANIFEST))
        for old in set(before.values()) - set(after.values()):
            delete_folder(self.spark, f"{self.path}/{old}")
        for p, old in before.items():
            if after.get(p) != old and old in after.values():
                for name in TABLES:
                    delete_folder(self.spark, f"{self.path}/{old}/{name}/part={p}")
        self.refresh()

    def insert(self, docs: DataFrame) -> None:
        """Take in documents; a doc_id that is in already keeps its old keys too."""
        self.refresh()
        shards, lines = self.shards, self.lines
        if lines is not None:
            text = F.coalesce(F.col("text").cast("string"), F.lit(""))
            lines += docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)).first()[0] or 0
            if not self.parts or lines > 2 * shards * SHARD_KEYS:
                shards = max(1, -(-lines // SHARD_KEYS))
        new = distinct_keys(docs, shards, self.min_chars).where("doc_id is not null").select(*KEYS, "doc_id")
        if not self.parts or shards != self.shards:
            old = self.read("postings").withColumn("shard", shard_of(shards))
            self.write(old.unionByName(new), list(range(min(shards, PARTS))), shards, lines)
            return
        with Scratch(self.spark) as scratch:
            new = scratch.written(new, "line-keys")
            parts = [r[0] for r in new.select(F.pmod("shard", F.lit(PARTS).cast("long"))).distinct().collect()]
            if parts:
                self.write(self.read("postings", parts).unionByName(new), parts, shards, lines)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents out again (column doc_id)."""
        self.refresh()
        gone = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        part = F.pmod("shard", F.lit(PARTS).cast("long"))
        parts = [r[0] for r in self.read("postings").join(gone, "doc_id", "left_semi").select(part).distinct().collect()]
        if parts:
            self.write(self.read("postings", parts).join(gone, "doc_id", "left_anti"), parts, self.shards, self.lines)

    def hits(self, docs: DataFrame) -> DataFrame:
        """(shard, hi, lo, doc_id) of the lines that the filters may hold."""
        filters = self.read("filters")
        if (filters.agg(F.sum(F.length("cells"))).first()[0] or 0) <= FILTER_BYTES:
            cells = [b""] * self.shards
            for row in filters.collect():
                cells[row["shard"]] = bytes(row["cells"])
            return distinct_keys(docs, self.shards, self.min_chars, cells).select(*KEYS, "doc_id")
        counts = self.read("counts").where("n_docs > 1")
        least = (counts.agg(F.sum("n_docs")).first()[0] or 0) / HOT
        hot = [np.array([r["hi"], r["lo"]], "<i8").tobytes() for r in counts.where(F.col("n_docs") >= least).select("hi", "lo").collect()]
        return met_filters(distinct_keys(docs, self.shards, self.min_chars, hot=hot), filters, self.shards)

    def clean(self, docs: DataFrame) -> DataFrame:
        """doc_id, kept (the text left), n_lines, n_dropped of every row of
        ``docs``: lines whose key another, smaller doc_id of the store keeps are dropped."""
        self.refresh()
        shared = self.read("counts").where("n_docs > 1").select(
            splittable("hi").alias("of_hi"), F.col("lo").alias("of_lo"), "keeper"
        )
        hits = self.hits(docs).where("doc_id is not null").distinct()
        drops = (
            hits.join(shared, (splittable("hi") == F.col("of_hi")) & (F.col("lo") == F.col("of_lo")))
            .where("doc_id > keeper")
            .groupBy(F.col("doc_id").alias("of_doc"))
            .agg(F.collect_list(F.struct("hi", "lo")).alias("drops"))
        )
        min_chars = self.min_chars
        names = ["doc_id", "kept", "n_lines", "n_dropped"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                out: list[list] = [[], [], []]
                for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist(), strict=True):
                    if not drops:
                        out[0].append(text or "")
                        out[1].append((text or "").count("\n") + 1)
                        out[2].append(0)
                        continue
                    gone = {np.array([d["hi"], d["lo"]], "<i8").tobytes() for d in drops}
                    lines, keys = line_keys(text, min_chars)
                    kept = [x for x, k in zip(lines, keys, strict=True) if k not in gone]
                    out[0].append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
                    out[1].append(len(lines))
                    out[2].append(len(lines) - len(kept))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names)

        return (
            with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .join(drops, F.col("doc_id") == F.col("of_doc"), "left")
            .select("doc_id", "text", "drops")
            .mapInArrow(run, "doc_id long, kept string, n_lines long, n_dropped long")
        )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = LineStore(spark)
    store.insert(docs)
    return store.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB text of op1.
OP1_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), k as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
), c as (
  select key, min(doc_id) as keeper, count(distinct doc_id) as n from k where length(key) >= 10 group by key having n >= 2
), m as (
  select k.*, c.key is not null and k.doc_id <> c.keeper as dropped from k left join c on k.key = c.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from m group by doc_id
"""
