"""Words of texts, and filters of fixed size over hashes; shared by operators 11 and 12.

A word is a maximal run of digits, letters and characters beyond ASCII, with
A-Z lower-cased.  All words of a batch are found at once on its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One word of a text in which A-Z are lower-cased, for Java's and DuckDB's patterns.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of texts that are taken together; a longer text is taken whole.
TOGETHER = 4 << 20
#: log2 of the bits of a filter: 8 MB, whatever the number of hashes in it.
FILTER_BITS = 26


def _word_bytes() -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        out[first : last + 1] = True
    return out


IN_WORD = _word_bytes()
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32


def sql_words(text: Column) -> Column:
    """The words of a text as a column expression."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, place of each word of all texts among them, bounds):
    the words of text i are those from ``bounds[i]`` to ``bounds[i + 1]``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[offsets < len(data)]
    first[heads] = inside[heads]  # a word does not go on from one text to the next
    start = np.flatnonzero(first)
    ends = np.append(np.cumsum(inside, dtype=np.int64)[start] - 1, inside.sum())
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(LOWERED[data[inside]])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(start, offsets)


def hashes_of(words: pa.Array) -> np.ndarray:
    """XXH64 (seed 42) of each word: what ``xxhash64`` gives in Spark, unsigned."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed=42) for w in words.to_pylist()), np.uint64, len(words))


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """``batches`` in pieces whose texts have about ``most`` bytes, one text at least."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most)))
            yield batch.slice(at, to - at)
            at = to


def filter_of(hashes: DataFrame, column: str = "hash", bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for each hash: 2**bits bits in all, so at most 2**(bits - 6) sums
    reach the driver, however many hashes there are.  A hash whose bit is not
    set is none of them; the others remain to be looked up."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    found = (
        hashes.groupBy(F.shiftright(place, 6).cast("int").alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(filter_bits).bit_length() - 1 + 6
    place = hashes >> np.uint64(64 - bits)
    return (filter_bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def row_numbers(start: int, n: int) -> np.ndarray:
    """Numbers of ``n`` rows of this task after its first ``start``; no other task has them."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return (task.partitionId() if task else 0) * (1 << 33) + np.arange(start, start + n, dtype=np.int64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """``values`` cut into lists of ``counts`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)
