"""Packing of documents into fixed-length sequences (operator 7).

Shortest-pack-first over the length histogram.  Documents are cut into pieces
of at most ``max_len`` ids.  Only the histogram of piece lengths (``max_len``
numbers at most) reaches the driver, where lengths are placed longest first,
each into the packs that are shortest so far, as counts of packing patterns.
Pieces of a length are then numbered by rank, and the patterns' slots, each a
range of ranks of one length, are joined back to them.

Input cases: a null or empty text is the end id alone; a text longer than
``max_len`` ids gives several pieces; repeated rows are packed each on its
own; an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webledger.llm.common import slices, table, with_python, written
from webledger.llm.pretoken import PieceIds, ids_of_texts

#: Rows of one length that are numbered in one task.
RANKED_TOGETHER = 50_000
#: Pieces that the tokenizer gets at once.
TOGETHER = 2048
#: The last of the Latin letters whose classes no version of Unicode disputes.
LATIN = "\u024f"


def byte_alphabet() -> dict[int, int]:
    """The characters of byte-level vocabularies: visible Latin-1 ones stand for themselves, other bytes follow U+0100."""
    hidden = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
    return {b: 0x100 + i for i, b in enumerate(hidden)}


def only_merges(vocabulary: str) -> bool:
    """Whether this tokenizer does nothing to a piece but merge its bytes."""
    t = json.loads(vocabulary)
    step = t.get("pre_tokenizer") or {}
    return (
        t["model"].get("type") == "BPE" and not t.get("normalizer") and step.get("type") == "ByteLevel" and not step.get("add_prefix_space")
        and not t.get("truncation") and not t.get("padding") and all(a.get("special") for a in t.get("added_tokens") or [])
    )


@functools.lru_cache(maxsize=2)
def known_ids(vocabulary: str) -> PieceIds:
    """Ids by the tokenizer of each distinct piece, one store for each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(vocabulary)
    t.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode_all(pieces: list[str]) -> list[list[int]]:
        # The library's results hold far more than ids, so few are held at a time.
        return [
            e.ids
            for i in range(0, len(pieces), TOGETHER)
            for e in t.encode_batch_fast(pieces[i : i + TOGETHER], add_special_tokens=False)
        ]

    if not only_merges(vocabulary):
        return PieceIds(encode_all)
    merge, alphabet = t.model.tokenize, byte_alphabet()

    def encode(pieces: list[str]) -> list[list[int]]:
        """As ``encode_all``, but Latin pieces go to the tokenizer's model at once: no step before it does more to
        them than change the characters.  Of other scripts the library may know other letters than Python, and cut again."""
        plain = [p.isascii() or max(p) <= LATIN for p in pieces]
        rest = iter(encode_all([p for p, x in zip(pieces, plain, strict=True) if not x]))
        return [
            [k.id for k in merge(p.encode().decode("latin-1").translate(alphabet))] if x else next(rest)
            for p, x in zip(pieces, plain, strict=True)
        ]

    return PieceIds(encode)


def cut_documents(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_ids(vocabulary)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of_texts(texts, known), strict=True):
                raw = np.append(ids, end_id).astype("<u4").tobytes()
                n = len(raw) // 4
                for start in range(0, n, max_len):
                    some = raw[4 * start : 4 * (start + max_len)]
                    for column, value in zip(out, (doc, start, len(some) // 4, zlib.crc32(some), n), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack_histogram(histogram: dict[int, int], max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns and how often each is used.

    ``open_packs[room]`` holds the patterns with that much room left.  A length
    goes to the packs with the most room, the shortest ones; where fewer packs
    than pieces fit, the rest opens new packs.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    full: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, room: int) -> None:
        if room:
            open_packs.setdefault(room, []).append((pattern, count))
        else:
            full.append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                put((length,), left, max_len - length)
                break
            pattern, count = open_packs[room].pop()
            take = min(left, count)
            if count > take:
                open_packs[room].append((pattern, count - take))
            if not open_packs[room]:
                del open_packs[room]
            put((*pattern, length), take, room - length)
            left -= take
    return full + [p for room in sorted(open_packs) for p in open_packs[room]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end of ranks, first sequence, offset) of every slot."""
    out, next_rank, first_sequence = [], {}, 0
    for lengths, count in patterns:
        for length, offset in zip(lengths, [0, *accumulate(lengths)], strict=False):
            rank = next_rank.get(length, 0)
            out.append((length, rank, rank + count, first_sequence, offset))
            next_rank[length] = rank + count
        first_sequence += count
    return out


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``pieces`` with their rank within their length.

    A length may hold most rows, so it is dealt over salts; a rank is the
    number of rows in the salts before plus the row's number in its own.
    """
    salts = max(256, -(-total // RANKED_TOGETHER))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "length", "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own")).drop("salt", "before", "own")


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    The slot table is built from at most ``max_len`` lengths.  It has a row
    for each step of the placement, each of which uses up a length or a
    pattern, so its size doesn't depend on the number of documents; it is
    broadcast.
    """
    spark: SparkSession = docs.sparkSession
    pieces = written(cut_documents(docs, tokenizer_path, max_len, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        slots(pack_histogram(histogram, max_len)),
        "slot_length long, rank_from long, rank_to long, first_sequence long, offset long",
    )
    fits = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return (
        ranked(pieces, sum(histogram.values()))
        .join(F.broadcast(places), fits)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
            "offset",
        )
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
