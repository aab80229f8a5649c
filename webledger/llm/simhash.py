"""SimHash near-dedup with Golay-code fuzzy hashing (operator 5).

A document's 64-bit fingerprint has a bit set where more than half of its
shingle hashes have it.  Distinct fingerprints are cut into three segments of
23, 23 and 18 bits.  If two fingerprints differ in at most four bits, then
either a segment is equal, and of the others one differs in at most two bits,
where the Golay keys of both share a codeword; or all three differ, and two of
them in exactly one bit, so that one of both words has even parity, and its
own codeword is among the keys of the other.  So a fingerprint gets a key for
each segment with each Golay key of each other segment, and for each pair of
segments the pairs of their Golay keys; equal keys bring fingerprints
together, and the bits are then counted.  (For five bits, two of the segments
differ in at most two bits each, and all pairs of Golay keys are needed.)

Fingerprints under one key are compared in a task up to ``TOGETHER`` of them;
the rest of larger groups is cut into blocks, and each pair of blocks is
compared in a task of its own.  A task returns links that connect what it
found connected, not all pairs.  Components are found by alternating large
and small stars.

Input cases: a null or empty text, or one of white space, has fingerprint
zero and links like any other; a text of fewer words than a shingle is one
shingle; repeated rows share fingerprint and component; a null doc_id gets a
fingerprint and no component and links nothing; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm import golay
from webledger.llm.common import slices, splittable, table, with_python, written

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: First bit and number of bits of each segment.
SEGMENTS = [(0, 23), (23, 23), (46, 18)]
#: Fingerprints of one key that are compared in one task.
TOGETHER = 4096
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit i is set where over half of the hashes of the text's shingles, repeats included, have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    first = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=first[1:])
    start, stop = first[: len(words) - size + 1].tolist(), (first[size:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(start, stop, strict=True)], "<u8")
    if len(hashes) < 500:
        set_bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        octets = hashes.view(np.uint8).reshape(-1, 8)
        set_bits = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, row: str | None = None) -> DataFrame:
    """row, doc_id and the fingerprint as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(fp)], ["row", "doc_id", "fp"])

    number = F.monotonically_increasing_id() if row is None else F.col(row).cast("long")
    few = with_python(docs).select(number.alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return few.mapInArrow(run, "row long, doc_id long, fp long")


def fuzzy_keys(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fp): all keys of each fingerprint."""
    keys = few_bit_keys if max_bits <= 4 else five_bit_keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 5_000):
                fp = every[at : at + 5_000]
                words = [((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
                for key, times in keys(words, [golay.keys(w) for w in words]):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(fp, times).view(np.int64))], ["key", "fp"])

    return with_python(fps).mapInArrow(run, "key int, fp long")


def five_bit_keys(words: list[np.ndarray], own: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys for up to five bits, and how many each fingerprint has: the pairs of two segments' Golay keys."""
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        (a, na), (b, nb) = own[i], own[j]
        key, real = pairs_of_keys(a, na, b, nb)
        yield (pair << 24 | key[real]).astype(np.int32), na * nb


def few_bit_keys(words: list[np.ndarray], own: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys for up to four bits, and how many each fingerprint has: a segment
    and the Golay keys of another one; and for two segments of one error each,
    in which the parities differ, the pairs of their keys, where a word of even
    parity needs only its own codeword."""
    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        b, nb = own[j]
        yield mixed(kind, (words[i][:, None] << 12 | b)[np.arange(6) < nb[:, None]]), nb
    odd = [np.bitwise_count(w) & 1 for w in words]
    for kind, (i, j) in enumerate(combinations(range(3), 2), start=6):
        (a, na), (b, nb) = ((own[s][0], np.where(odd[s] == 1, own[s][1], 1)) for s in (i, j))
        key, real = pairs_of_keys(a, na, b, nb)
        unlike = np.repeat((odd[i] ^ odd[j]).astype(np.int64), na * nb)
        yield mixed(kind, unlike << 24 | key[real]), na * nb


def pairs_of_keys(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the (n, 6) keys a and b of each row, and which of the 36 stand for one."""
    key = (a[:, :, None] << 12 | b[:, None, :]).reshape(len(a), 36)
    return key, ((np.arange(6) < na[:, None])[:, :, None] & (np.arange(6) < nb[:, None])[:, None, :]).reshape(len(a), 36)


def mixed(kind: int, key: np.ndarray) -> np.ndarray:
    """Keys of a kind, hashed to 32 bits: the bits are counted anyway."""
    return ((kind << 35 | key).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def connected(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of at most ``max_bits`` connect among ``fp``: each to its component's first."""
    left, out_a, out_b = fp, [], []
    while len(left):
        root, seen, left = left[0], left[:1], left[1:]
        while len(seen) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(seen), 256):
                rest = np.flatnonzero(~near)
                near[rest] = (np.bitwise_count(seen[at : at + 256, None] ^ left[rest]) <= max_bits).any(axis=0)
            seen, left = left[near], left[~near]
            out_a.append(np.full(len(seen), root))
            out_b.append(seen)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def links_of_groups(fp: np.ndarray, first: np.ndarray, size: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of ``fp`` (group g is size[g] long from first[g])."""
    out = []
    for n in np.unique(size):
        begin = first[size == n]
        if n < 2:
            continue
        if n <= 24:
            i, j = np.triu_indices(n, 1)
            for at in range(0, len(begin), 50_000):
                rows = begin[at : at + 50_000, None]
                a, b = fp[rows + i].ravel(), fp[rows + j].ravel()
                near = np.bitwise_count(a ^ b) <= max_bits
                out.append((a[near], b[near]))
        else:
            out += [connected(fp[k : k + n], max_bits) for k in begin.tolist()]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *(a for a, _ in out)]), np.concatenate([empty, *(b for _, b in out)])


def link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
    n = len(pairs)
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64)), pa.nulls(n, pa.int32())], ["a", "b", "key"]
    )


def compare_sorted(keyed: DataFrame, max_bits: int, together: int) -> DataFrame:
    """(a, b, key) from (key, fp) sorted by key within partitions: links where
    key is null; rows of groups over ``together`` unchanged as (fp, null, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_key, hold_fp, over = np.zeros(0, np.int32), np.zeros(0, np.uint64), None

        def passed(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64()), pa.array(key)], ["a", "b", "key"])

        def whole(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(first, len(key)))
            large = size > together
            for f, n in zip(first[large].tolist(), size[large].tolist(), strict=True):
                yield passed(key[f : f + n], fp[f : f + n])
            yield link_batch(*links_of_groups(fp, first[~large], size[~large], max_bits))

        for batch in batches:
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            if over is not None:  # the rest of a group that was too large to hold
                same = int(np.searchsorted(key, over, side="right"))
                yield passed(key[:same], fp[:same])
                key, fp = key[same:], fp[same:]
                if not len(key):
                    continue
                over = None
            key, fp = np.concatenate([hold_key, key]), np.concatenate([hold_fp, fp])
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield from whole(key[:last], fp[:last])
            hold_key, hold_fp = key[last:], fp[last:]
            if len(hold_key) > together:
                over = int(hold_key[0])
                yield passed(hold_key, hold_fp)
                hold_key, hold_fp = hold_key[:0], hold_fp[:0]
        if len(hold_key):
            yield from whole(hold_key, hold_fp)

    return with_python(keyed).mapInArrow(run, "a long, b long, key int")


def compare_blocks(rows: DataFrame, max_bits: int, together: int) -> DataFrame:
    """Links (a, b) of the large groups' rows (key, fp), block against block."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("key").alias("of_key"), F.ceil(F.col("n") / together).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = rows.join(sizes, F.col("key") == F.col("of_key")).select("key", "fp", block.alias("own"), other.alias("with"))
    task = F.struct("key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    dealt = pairs.select(F.xxhash64(task).alias("task"), "fp").repartition("task").sortWithinPartitions("task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            task = np.concatenate([task, batch.column("task").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            last = int(np.searchsorted(task, task[-1])) if len(task) else 0
            yield from linked(task[:last], fp[:last])
            task, fp = task[last:], fp[last:]
        yield from linked(task, fp)

    def linked(task: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(task):
            first = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
            yield link_batch(*links_of_groups(fp, first, np.diff(np.append(first, len(task))), max_bits)).select(["a", "b"])

    return with_python(dealt).mapInArrow(run, "a long, b long")


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, together: int = TOGETHER) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect
    exactly what differences of at most ``max_bits`` bits connect."""
    if max_bits > 5:
        raise ValueError("three segments find differences of up to five bits")
    keyed = fuzzy_keys(fps, max_bits).repartition("key").sortWithinPartitions("key")
    found = written(compare_sorted(keyed, max_bits, together), "links")
    links = found.where("key is null").select("a", "b")
    large = found.where("key is not null").select("key", F.col("a").alias("fp"))
    if large.isEmpty():
        return links.distinct()
    return links.unionByName(compare_blocks(large, max_bits, together)).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable."""
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        state, before = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first(), state
        if state == before:
            break
        # Large star: each node's larger neighbours are linked to its least neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = starred(both, F.col("v") > F.col("u")).distinct()
        # Small star: a node's smaller neighbours, and itself, are linked to the least of them.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = starred(edges, F.col("v") != F.col("m")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def starred(edges: DataFrame, chosen) -> DataFrame:
    """Each chosen neighbour v of u, linked to the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(splittable("u").alias("k"), F.least("u", "m").alias("m"))
    return edges.join(least, splittable("u") == F.col("k")).where(chosen).select(F.col("v").alias("u"), F.col("m").alias("v"))


def near_groups(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, row: str | None = None) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of ``docs``.

    With ``row``, a column that numbers the rows, those without doc_id link
    like any other, and there are two more columns: this number, and
    ``stays``, true for exactly one row of each component: of the smallest
    doc_id's rows the first, and one without doc_id only if no other is there.
    """
    own = written(fingerprints(docs, size, row), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    first = own.groupBy("fp").agg(best.alias("best"))
    first = written(first.where("not best.unnamed") if row is None else first, "distinct")
    found = components(near_links(first.select("fp"), max_bits)).select(F.col("node").alias("of_fp"), "component")
    member = written(first.join(found, F.col("fp") == F.col("of_fp"), "left").select("fp", F.coalesce("component", "fp").alias("component"), "best"), "members")
    heads = member.groupBy("component").agg(F.min("best").alias("head")).select(splittable("component").alias("k"), "head")
    of_fp = member.join(heads, splittable("component") == F.col("k")).select(splittable("fp").alias("k"), "head")
    every = own.join(of_fp, splittable("fp") == F.col("k"), "left").select(
        "row", "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("head.doc_id")).alias("component_id"), (F.col("row") == F.col("head.row")).alias("stays")
    )
    return every.select("doc_id", "fp", "component_id") if row is None else every.withColumnRenamed("row", row)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
