"""Byte-level BPE encoding and decoding (operator 9).

Each distinct piece of a batch is a row of a padded matrix of ids, and rows
of like length share a matrix.  Each round merges the leftmost pair of least
rank of every row; a merged row closes the gap, a row without a mergeable
pair leaves the matrix.  Ranks of pairs stand in an open-addressing hash
table made of numpy arrays.

Input cases: a null or empty text has no ids; repeated rows give repeated
results; other columns of the input pass through ``encode`` untouched unless
they have the name of the new column, which replaces them.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webledger.llm.common import slices, table, with_python
from webledger.llm.pretoken import PieceIds, ids_of_texts

NONE = np.int32(2**31 - 1)
#: A piece of more bytes than this is merged with a heap: a matrix row needs a round for each merge.
LONG_PIECE = 512
#: Cells of one matrix at most.
CELLS = 2_000_000


def read_ranks(path: str) -> bytes:
    """The rank file, read once on the driver; tasks get its bytes (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class PairTable:
    """Ranks of id pairs by hashing with linear probing."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        left = np.fromiter((p[0] for p in pairs), np.uint64, len(pairs))
        right = np.fromiter((p[1] for p in pairs), np.uint64, len(pairs))
        keys, ranks = (left << np.uint64(32)) | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        at, todo = self.slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at] == np.uint64(2**64 - 1)
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(at), bool)
            take[first] = True
            take &= free
            self.keys[at[take]], self.ranks[at[take]] = keys[todo[take]], ranks[todo[take]]
            todo, at = todo[~take], (at[~take] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the pair doesn't merge or an id is negative."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(np.uint64) << np.uint64(32)) | right[todo].astype(np.uint64)
        at = self.slot(keys)
        while len(todo):
            here = self.keys[at]
            hit = here == keys
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (here != np.uint64(2**64 - 1))
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & self.mask
        return out.reshape(shape)


class Codec:
    """Encodes and decodes with one rank file."""

    def __init__(self, data: bytes):
        self.ranks = parse_ranks(data)
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs = pairs
        self.table = PairTable(pairs)
        self.known = PieceIds(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list = [None] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            if b in self.ranks:
                out[i] = [self.ranks[b]]
            elif len(b) > LONG_PIECE:
                out[i] = self.merge_long(b)
            else:
                buckets.setdefault((len(b) + 3) // 4 * 4, []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                for i, ids in zip(some, self.merge_matrix([raw[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def merge_matrix(self, raw: list[bytes], width: int) -> list[list[int]]:
        cells = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in raw), np.uint8).reshape(len(raw), width)
        size = np.array([len(b) for b in raw])
        ids = self.single[cells]
        ids[np.arange(width)[None, :] >= size[:, None]] = -1
        rank = self.table.find(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(len(raw)), [None] * len(raw)
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            least = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NONE)
            done = least == NONE
            if done.any():
                for r, x in zip(row[done].tolist(), ids[done].tolist(), strict=True):
                    out[r] = [i for i in x if i >= 0]
                go = ~done
                row, ids, rank, best, least = row[go], ids[go], rank[go], best[go], least[go]
                if not len(row):
                    break
            n, w = ids.shape
            at = np.arange(n)
            ids[at, best] = least
            keep = np.ones((n, w), bool)
            keep[at, best + 1] = False
            ids = ids[keep].reshape(n, w - 1)
            keep = np.ones((n, w - 1), bool)
            keep[at, best] = False
            rank = rank[keep].reshape(n, w - 2)
            has = best > 0
            rank[at[has], best[has] - 1] = self.table.find(ids[at[has], best[has] - 1], ids[at[has], best[has]])
            has = best < w - 2
            rank[at[has], best[has]] = self.table.find(ids[at[has], best[has]], ids[at[has], best[has] + 1])
        return out

    def merge_long(self, raw: bytes) -> list[int]:
        """The same merges of one long piece, with a heap over a linked list."""
        ids = self.single[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        get = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = r, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x, on in zip(ids, alive, strict=True) if on]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        return ids_of_texts(texts, self.known)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    """One codec for each Python worker and rank file."""
    return Codec(data)


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the array of ids of column ``text``."""
    data = read_ranks(path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([x.astype(np.int32) for x in codec(data).encode(s.fillna("").tolist())], index=s.index, dtype=object)

    return with_python(df).withColumn(into, ids(F.col(text).cast("string")))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that column ``ids`` stands for (null: empty)."""
    data = read_ranks(path)

    @F.pandas_udf(T.BinaryType())
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([b"" if x is None else codec(data).decode(list(x)) for x in s], index=s.index, dtype=object)

    return with_python(df).withColumn(into, back(F.col(ids)))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the number of ids, and digests of the ids and of the bytes they
    decode to; ids and bytes exist in the task only."""
    import hashlib

    data = read_ranks(path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(data)
        names = {i: str(i) for i in c.bytes_of}
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n, ids_sha, back_sha = [], [], []
            for ids in c.encode(texts):
                ids = ids.tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                back_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)



def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
