"""Ranked lexical search for many queries at once, by common-subexpression evaluation (operator 12).

A score is a sum of one addend per query term, so queries with terms in
common share partial sums.

- One pass over the documents counts, for each, its words that are query
  terms; frequencies, weights and lengths are aggregates of that table.
- Items are dealt into blocks.  In each block, shared term sets are mined: with
  its terms ordered from the most shared one on, every item is a sequence, and
  neighbours that stand together in several items become a node of their own,
  again and again, until no pair does.  Nodes are made of nodes, and several
  items and nodes use them: a directed acyclic graph of sums.
- Documents are dealt into blocks too.  A task takes a block of each and fills
  one accumulator per node and document, each once, a round of nodes after the
  other; an item's scores are the sums of the few nodes it has left.  The best
  of each block are then merged by item.

Input cases: a null or empty text has no terms, is not counted in N and has
score 0; rows that repeat an item_id are one item with the terms of all; a
null item_id is an item of its own; every row of the documents is ranked by
itself, also if a doc_id is repeated; a null doc_id comes after equal scores
with a number; an item of which no term occurs gives no rows; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webledger.llm.common import table, with_python, written
from webledger.llm.words import filter_of, hashes_of, lists, may_hold, portions, row_numbers, sql_words, words_of

#: Documents of a block; query terms of a block, about (an item is not cut).
DOCUMENTS, TERMS = 4096, 50_000
#: Accumulators that a task holds at a time.
CELLS = 1 << 22


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times: how often each item has each of its terms."""
    each = items.select(F.col("item_id").cast("long"), F.explode(sql_words(F.col("text"))).alias("term"))
    return each.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """row, doc_id, n, terms, counts: of each row with a word at all, its length in
    words, and its words that ``terms`` (term) may hold, with their number."""
    hashed = terms.select(F.xxhash64("term").alias("hash")).distinct()
    passes = docs.sparkSession.sparkContext.broadcast(filter_of(hashed, bits=23))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in portions(batches):
            distinct, codes, bounds = words_of(batch.column("text"))
            wanted = may_hold(passes.value, hashes_of(distinct))[codes]
            doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[wanted]
            pair, times = np.unique(doc * max(1, len(distinct)) + codes[wanted], return_counts=True)
            each = np.bincount(pair // max(1, len(distinct)), minlength=batch.num_rows)
            out = pa.record_batch({
                "row": row_numbers(seen, batch.num_rows), "doc_id": batch.column("doc_id"), "n": np.diff(bounds),
                "terms": lists(distinct.take(pa.array(pair % max(1, len(distinct)))).cast(pa.string()), each), "counts": lists(pa.array(times.astype(np.int64)), each),
            })
            seen += batch.num_rows
            yield out.filter(pc.greater(out.column("n"), 0))

    few = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_python(few).mapInArrow(count, "row long, doc_id long, n long, terms array<string>, counts array<long>")


def shared_sums(items: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Mine shared sets from items given as arrays of distinct leaves 0, 1, ...

    Returns (rounds, rest, nodes).  ``rounds`` are arrays of (node, left,
    right): the node is the sum of two nodes of earlier rounds or leaves.
    ``rest`` are the nodes whose sum each item is.
    """
    nodes = 1 + max((int(i.max()) for i in items if len(i)), default=-1)
    shared = np.bincount(np.concatenate([np.zeros(0, np.int64), *items]), minlength=nodes)
    # Leaves that the same items have come next to each other: rank by use, then by the items' own numbers.
    mark = np.zeros(nodes, np.uint64)
    for k, item in enumerate(items):
        mark[item] += np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
    rank = np.empty(nodes, np.int64)
    rank[np.lexsort((np.arange(nodes), mark, -shared))] = np.arange(nodes)
    sequence = np.concatenate([np.zeros(0, np.int64), *(i[np.argsort(rank[i])] for i in items)])
    owner = np.repeat(np.arange(len(items)), [len(i) for i in items])
    rounds: list[np.ndarray] = []
    while len(sequence) > 1:
        code = sequence[:-1] * nodes + sequence[1:]
        pairs, at, uses = np.unique(code, return_inverse=True, return_counts=True)
        together = owner[:-1] == owner[1:]
        uses = np.bincount(at[together], minlength=len(pairs))
        key = np.where(together & (uses[at] > 1), uses[at] * len(pairs) + at + 1, 0)
        # Of overlapping pairs the one used most; equal keys are equal pairs and cannot overlap, as leaves are distinct.
        around = np.concatenate(([0], key, [0]))
        taken = np.flatnonzero((key > 0) & (key > around[:-2]) & (key > around[2:]))
        again = np.bincount(at[taken], minlength=len(pairs))
        taken = taken[again[at[taken]] > 1]
        if not len(taken):
            break
        made, new = np.unique(at[taken], return_inverse=True)
        rounds.append(np.stack((nodes + np.arange(len(made)), pairs[made] // nodes, pairs[made] % nodes)))
        sequence[taken] = nodes + new
        keep = np.ones(len(sequence), bool)
        keep[taken + 1] = False
        sequence, owner = sequence[keep], owner[keep]
        nodes += len(made)
    return rounds, np.split(sequence, np.searchsorted(owner, np.arange(1, len(items)))) if items else [], nodes


def plan_of(block: pa.Table) -> pa.Table:
    """One row with the graph of a block of items (qb, item_id, term, times, weight)."""
    terms = block.column("term").combine_chunks().dictionary_encode()
    weight = np.zeros(len(terms.dictionary), np.int64)
    code = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    weight[code] = block["weight"].to_numpy()
    # A leaf is a term and how often an item has it.
    times = block["times"].to_numpy()
    leaf_key, leaf = np.unique(np.stack((code, times)), axis=1, return_inverse=True)
    owner = block.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    by = owner.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(by, kind="stable")
    items = np.split(leaf.reshape(-1)[order], np.flatnonzero(np.diff(by[order])) + 1)
    rounds, rest, nodes = shared_sums(items)
    one = {
        "qb": block["qb"][:1].combine_chunks(), "items": pa.array([owner.dictionary.to_pylist()], pa.list_(pa.int64())), "terms": pa.array([terms.dictionary.to_pylist()], pa.list_(pa.string())),
        "weights": [weight.tolist()], "leaf_term": [leaf_key[0].tolist()], "leaf_times": [leaf_key[1].tolist()], "rounds": pa.array([[r.reshape(-1).tolist() for r in rounds]], pa.list_(pa.list_(pa.int64()))),
        "rest": pa.array([np.concatenate(rest).tolist()], pa.list_(pa.int64())), "rest_sizes": pa.array([[len(r) for r in rest]], pa.list_(pa.int64())), "nodes": pa.array([nodes], pa.int64()),
    }
    return pa.table(one)


PLAN = "qb long, items array<long>, terms array<string>, weights array<long>, leaf_term array<long>, leaf_times array<long>, rounds array<array<long>>, rest array<long>, rest_sizes array<long>, nodes long"


def block_scores(plan: dict, docs: pa.Table, k: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the item, place of the document, score): each item's k best documents of a block with a score above 0.

    ``docs`` (row, doc_id, m, terms, counts) come in the order in which equal scores rank.
    """
    terms, weights = pa.array(plan["terms"], pa.string()), np.array(plan["weights"], np.int64)
    leaf_term, leaf_times = np.array(plan["leaf_term"], np.int64), np.array(plan["leaf_times"], np.int64)
    rounds = [np.array(r, np.int64).reshape(3, -1) for r in plan["rounds"]]
    rest, sizes = np.array(plan["rest"], np.int64), np.array(plan["rest_sizes"], np.int64)
    listed = docs.column("terms").combine_chunks()
    each = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
    term = pc.fill_null(pc.index_in(listed.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False)
    tf = docs.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(each)), each)
    known = term >= 0
    term, tf, doc = term[known], tf[known], doc[known]
    addend = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * docs["m"].to_numpy()[doc]))
    heads, out = np.append(0, np.cumsum(sizes)[:-1]), []
    step = max(1, cells // max(1, plan["nodes"]))
    for low in range(0, len(each), step):
        n = min(step, len(each) - low)
        a, b = np.searchsorted(doc, (low, low + n))
        single = np.zeros((len(terms), n), np.int64)
        single[term[a:b], doc[a:b] - low] = addend[a:b]
        sums = np.empty((plan["nodes"], n), np.int64)
        sums[: len(leaf_term)] = single[leaf_term] * leaf_times[:, None]
        for node, left, right in rounds:
            sums[node] = sums[left] + sums[right]
        scores = np.add.reduceat(sums[rest], heads, axis=0)
        least = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.zeros(len(scores), np.int64)
        item, at = np.nonzero((scores >= np.maximum(least, 1)[:, None]))
        score = scores[item, at]
        order = np.lexsort((at, -score, item))
        item, at, score = item[order], at[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        out.append((item[place < k], at[place < k] + low, score[place < k]))
    empty = (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(empty, *out, strict=True))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, documents: int = DOCUMENTS, terms_of_block: int = TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents."""
    asked = written(query_terms(items), "query-terms")
    vocabulary = asked.select("term").distinct()
    counts = written(term_counts(docs, vocabulary), "term-counts")
    n_docs, length = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_terms = asked.count()

    holding = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    weighted = vocabulary.join(holding, "term").select("term", weight.alias("weight"))  # a term in no document adds nothing
    blocks = -(-max(1, n_terms) // terms_of_block)
    query = asked.join(weighted, "term").withColumn("qb", F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1))), F.lit(blocks)))
    plans = written(with_python(query).groupBy("qb").applyInArrow(plan_of, PLAN), "plans")

    dealt = -(-max(1, n_docs) // documents)
    db, m = F.pmod(F.xxhash64("row"), F.lit(dealt)), F.expr(f"25L + (75L * n * {n_docs}L) div {max(1, length)}L")
    given = counts.select("row", "doc_id", "terms", "counts", m.alias("m"), db.alias("db"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("qb"))
    used = plans.withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(dealt - 1)).cast("array<long>")))

    def best(plan: pa.Table, of: pa.Table) -> pa.Table:
        none = (np.zeros(0, np.int64),) * 3
        if not (plan.num_rows and of.num_rows):
            return pa.table(dict(zip(("item_id", "row", "doc_id", "score"), map(pa.array, (*none, none[0])), strict=True)))
        of = of.sort_by([("doc_id", "ascending"), ("row", "ascending")])  # nulls last
        p = plan.drop_columns(["qb", "db"]).to_pylist()[0]
        item, at, score = block_scores(p, of, k)
        return pa.table({"item_id": pa.array(p["items"], pa.int64()).take(pa.array(item)), "row": of["row"].take(pa.array(at)), "doc_id": of["doc_id"].take(pa.array(at)), "score": score})

    each = used.groupBy("db", "qb").cogroup(given.groupBy("db", "qb")).applyInArrow(best, "item_id long, row long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: DuckDB text of op12.
OP12_SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), c as (
  select count(*) as nn, sum(len(w)) as ll from d where len(w) > 0
), tf as (
  select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by r, term
), wt as (
  select term, cast(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) as bigint) as weight
  from (select term, count(*) as df from tf group by term), c
), q as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term
), s as (
  select q.item_id, d.r, d.doc_id,
         cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * nn) // ll)))) as bigint) as score
  from q join wt using (term) join tf using (term) join d using (r), c group by q.item_id, d.r, d.doc_id
), k as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last, r) as integer) as rank from s where score > 0
)
select item_id, rank, doc_id, score from k where rank <= 10
"""
