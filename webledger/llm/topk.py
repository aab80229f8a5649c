"""Exact top-k inner products by no-random-access aggregation (operator 10).

Candidates and queries are dealt into blocks, and a task takes one block of
each.  In a candidate block every component has a list of the candidates
sorted by its value.  A query reads all lists in step, from the top where its
own component is positive and from the bottom where it is negative.  What has
been read gives each candidate's score a lower and an upper bound: a value
not read yet is at most the last one read, and at least the list's end.  When
only a few candidates' upper bounds reach the k-th largest lower bound, the
others can't qualify: reading stops and the scores of those few are resolved.
Queries of a block read together, as the bounds of all are products of
matrices.  The best of each block are then merged by query.

Input cases: vectors that are null or hold a null, NaN or infinite component
take no part; an absent component of a shorter vector counts as zero; equal
scores go to the smaller vec_id; where a vec_id is repeated, each of its rows
is a query of its own, with its own ranks, and a candidate of the others: only
the query's own row is left out; a null vec_id takes no part; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webledger.llm.common import table, with_python, written

CANDIDATES, QUERIES = 2048, 512
#: Parts of the lists that are read before the bounds are looked at.
DEPTHS = (1 / 8, 1 / 2)


def quantised(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def rows_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as a matrix, shorter lists filled with zeros."""
    column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out


def largest(queries: np.ndarray, vectors: np.ndarray) -> float:
    """No sum of products is larger than this."""
    return float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(vectors.astype(float)).max(initial=0)) * max(1, vectors.shape[1])


def fitting_type(most: float) -> type:
    """The fastest number type in which all products and sums up to ``most`` are exact."""
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def block_top(
    query_keys: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, keys: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query key, vector id, score) of each query's k best in one block, those
    with its own key (``keys``: the ids if not given) left out; ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    keys = (ids if keys is None else keys)[order]
    ids, vectors = ids[order], vectors[order]
    most = largest(queries, vectors)
    kind = fitting_type(most)
    exact_q, exact_x = queries.astype(kind), vectors.astype(kind)
    up, down = np.maximum(exact_q, 0), np.minimum(exact_q, 0)
    n = len(ids)
    ranked = np.sort(vectors, axis=0)  # every component's list, ascending
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo = np.arange(len(query_keys))

    def own(q: np.ndarray) -> np.ndarray:
        return query_keys[q][:, None] == keys[None, :]

    def give(q: int, at: np.ndarray, score: np.ndarray) -> None:
        best = np.lexsort((at, -score))[:k]  # at ascends with the id
        out.append((np.full(len(best), query_keys[q]), ids[at[best]], score[best].astype(np.int64)))

    # A score that fits a long comes out right even if a sum on the way doesn't fit; a bound might not.
    for depth in DEPTHS if most < 2**62 else ():
        read = int(n * depth)
        if read <= k or not len(todo):
            continue
        low, high = ranked[0], ranked[-1]
        top, bottom = ranked[n - read], ranked[read - 1]
        from_top, from_bottom = vectors >= top, vectors <= bottom
        lower = bounds(up[todo], down[todo], np.where(from_top, vectors, low), np.where(from_bottom, vectors, high), kind)
        upper = bounds(up[todo], down[todo], np.where(from_top, vectors, top), np.where(from_bottom, vectors, bottom), kind)
        lower[own(todo)] = -np.inf if kind is not np.int64 else np.iinfo(np.int64).min
        threshold = np.partition(lower, n - k, axis=1)[:, n - k]
        open_ = (upper >= threshold[:, None]) & ~own(todo)
        few = open_.sum(axis=1) <= max(4 * k, n // 16)
        for row in np.flatnonzero(few).tolist():
            at = np.flatnonzero(open_[row])
            give(todo[row], at, exact_x[at] @ exact_q[todo[row]])
        todo = todo[~few]
    if len(todo):
        # Read to the end, the bounds meet in the scores.
        scores = exact_q[todo] @ exact_x.T
        mine = own(todo)
        for row, q in enumerate(todo.tolist()):
            s = scores[row]
            at = np.flatnonzero(~mine[row])
            if len(at) > k:
                least = np.partition(s[at], len(at) - k)[len(at) - k]
                at = at[s[at] >= least]
            give(q, at, s[at])
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *(o[i] for o in out)]) for i in range(3))


def bounds(up: np.ndarray, down: np.ndarray, for_up: np.ndarray, for_down: np.ndarray, kind: type) -> np.ndarray:
    return up @ for_up.astype(kind).T + down @ for_down.astype(kind).T


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row that is a query."""
    points = written(
        vectors.where(F.col(id_column).isNotNull() & usable(F.col(vector))).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
        ),
        "points",
    )
    n, asked = points.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    c_blocks, q_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-asked // QUERIES))
    block = F.xxhash64("row")
    candidates = points.select("row", "id", "v", F.pmod(block, F.lit(c_blocks)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"))
    queries = points.where("asks").select("row", "id", "v", F.pmod(block, F.lit(q_blocks)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb"))

    def best(q: pa.Table, c: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 4
        if len(q) and len(c):
            width = max(int(pc.max(pc.list_value_length(t["v"])).as_py() or 0) for t in (q, c))
            rows, ids = q["row"].to_numpy(), q["id"].to_numpy()
            row, vec_id, score = block_top(rows, rows_of(q["v"], width), c["id"].to_numpy(), rows_of(c["v"], width), k, c["row"].to_numpy())
            order = np.argsort(rows)
            found = (row, ids[order[np.searchsorted(rows, row, sorter=order)]], vec_id, score)
        return pa.table(dict(zip(("query_row", "query_id", "vec_id", "score"), map(pa.array, found), strict=True)))

    each = with_python(queries).groupBy("cb", "qb").cogroup(candidates.groupBy("cb", "qb")).applyInArrow(best, "query_row long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: DuckDB text of op10.
OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""
