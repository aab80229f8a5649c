"""K2: replay a fetch log through the 24-hour URL cache in time order.

Semantics (the reference's cache, applied to a whole log): per URL, a
request is a miss when nothing is cached, when the entry is older than the
TTL (exactly the TTL is still fresh) or when another format is cached; a
miss rewrites the entry, a hit does not renew it.  A request without URL or
time is a miss and writes nothing.

Plan.  A format change always misses, so the log splits into *runs* of
consecutive same-format requests per URL, and within a run the misses are the
chain "first request later than last miss + TTL".  The log is cut into
*bins*: a URL's requests within 1/288 of the TTL.  It is shuffled once, by
(url, bin), and written as a bucketed table.  What a bin does to the cache is
then combined in two levels, over the bins of a URL (whose number time bounds,
not traffic):

* Formats: a bin's first and last format and its last change give every bin
  the format and the start of the run it begins in.
* Expiry: only requests later than run start + TTL can miss by age; the others
  need no more work.  A probe (miss + TTL) lies at the same place in its TTL
  period as the miss, so the bins at one such place form a segment in which
  chains go from bin to bin, and where a chain leaves its segment it goes on
  with the first request of the run's next bin.  So for each bin's first
  request the segment's map tells the bin the chain leaves from, and one pass
  over a run's bins composes the maps and finds the ones its chain takes.

A URL that holds a third of the log is spread over its bins and segments, and
no request history is gathered in a row or held in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webledger.functions.exprs import epoch_micros
from webledger.operators.cache import NOT_CACHED, verdict_text
from webledger.operators.windows import prefix_scan
from webledger.session import bucketed_table, cut_lineage, drop_bucketed, ship_package, stored

HOUR_US = 3_600_000_000
#: Bins in one TTL period (an hour divides by it in microseconds).
SEGMENTS = 288


def replay_cache(log: DataFrame, ttl_hours: int = 24) -> DataFrame:
    """``log``: request_id, url, format, ts, tool, credits.  Returns
    request_id, hit, reason (the reference's texts)."""
    if ttl_hours < 1:
        raise ValueError("the time to live is a whole number of hours, at least one")
    ttl = ttl_hours * HOUR_US
    width = ttl // SEGMENTS
    base = log.select(
        "request_id", "url", F.coalesce("format", F.lit("markdown")).alias("fmt"), "ts", "tool", "credits",
        epoch_micros(F.col("ts")).alias("us"),
    )
    timed = F.col("url").isNotNull() & F.col("us").isNotNull()
    binned = base.where(timed).withColumn("bin", F.floor(F.col("us") / width))
    in_bin = Window.partitionBy("url", "bin").orderBy("us", "request_id")
    n = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = bucketed_table(
        binned.withColumns({"p_fmt": F.lag("fmt").over(in_bin), "p_us": F.lag("us").over(in_bin)}), ["url", "bin"], n, "replay")

    rows = with_runs(rows).withColumn("late", F.col("us") > F.col("run_us") + ttl)
    expiries = late_misses(rows.where("late").select("url", "run_us", "bin", "us"), ttl, width)
    # At most one run is older than the TTL within a bin, and misses by age at most once there.
    rows = rows.join(expiries, ["url", "bin"], "left")
    again = F.coalesce(F.col("p_us") == F.col("us"), F.lit(False))
    by_age = F.coalesce(F.col("late") & (F.col("us") == F.col("expiry_us")) & ~again, F.lit(False))
    rows = rows.withColumn("miss", F.col("is_start") | by_age)

    # The entry each request sees: the bin's last miss before it, or the last one of an earlier bin.
    written = F.when(F.col("miss"), F.struct("us", "request_id", "fmt", "tool", "ts", "credits"))
    carried = before_each_bin(rows.groupBy("url", "bin").agg(F.max(written).alias("last_entry")), "last_entry", "carried_entry")
    inside = F.last(written, ignorenulls=True).over(in_bin.rowsBetween(Window.unboundedPreceding, -1))
    seen = rows.withColumn("inside", inside).join(carried, ["url", "bin"]).withColumn("seen", F.coalesce("inside", "carried_entry"))
    reason = verdict_text(F.col("seen").isNull(), F.col("us") - F.col("seen.us") > ttl, F.col("seen.fmt") != F.col("fmt"),
                          F.col("seen.fmt"), F.col("fmt"), F.col("seen.tool"), F.col("seen.ts"), F.col("seen.credits"))
    untimed = base.where(~timed).select("request_id", F.lit(False).alias("hit"), F.lit(NOT_CACHED).alias("reason"))
    return seen.select("request_id", (~F.col("miss")).alias("hit"), reason.alias("reason")).unionByName(untimed)


def before_each_bin(bins: DataFrame, value: str, out: str) -> DataFrame:
    """url, bin and ``out``: the latest ``value`` of the URL's earlier bins (``bins``: one row for each)."""
    earlier = Window.partitionBy("url").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.select("url", "bin", F.last(value, ignorenulls=True).over(earlier).alias(out))


def with_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (url, bin, us, request_id, fmt; p_fmt: the format before it in
    its bin) with ``is_start`` and ``run_us``, the time its run began."""
    at = F.struct("us", "request_id")
    changed = F.col("p_fmt").isNotNull() & (F.col("p_fmt") != F.col("fmt"))
    bins = rows.groupBy("url", "bin").agg(
        F.min_by("fmt", at).alias("first_fmt"), F.max_by("fmt", at).alias("last_fmt"), F.min("us").alias("first_us"),
        F.max(F.when(changed, F.col("us"))).alias("change_us"),
    )
    by_url = Window.partitionBy("url").orderBy("bin")
    bins = bins.withColumn("before_fmt", F.lag("last_fmt").over(by_url))
    begins = F.col("before_fmt").isNull() | (F.col("before_fmt") != F.col("first_fmt"))
    bins = bins.withColumn("start_us", F.coalesce("change_us", F.when(begins, F.col("first_us"))))
    earlier = by_url.rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("url", "bin", "before_fmt", F.last("start_us", ignorenulls=True).over(earlier).alias("carried_us"))
    before = F.coalesce("p_fmt", "before_fmt")
    so_far = Window.partitionBy("url", "bin").orderBy("us", "request_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(bins, ["url", "bin"])
        .withColumn("is_start", before.isNull() | (before != F.col("fmt")))
        .withColumn("run_us", F.coalesce(F.max(F.when(F.col("is_start"), F.col("us"))).over(so_far), F.col("carried_us")))
        .drop("before_fmt", "carried_us")
    )


def late_misses(late: DataFrame, ttl: int, width: int) -> DataFrame:
    """url, bin, expiry_us: the times at which runs miss by age, at most one a bin.

    ``late``: url, run_us, bin and us of the requests later than run_us + ttl;
    ``width`` is that of a bin and divides ``ttl``."""
    ship_package(late.sparkSession)
    place = F.pmod("bin", F.lit(ttl // width))
    dealt = late.withColumn("place", place).repartition("url", "run_us", "place").sortWithinPartitions("url", "run_us", "place", "us")
    maps = dealt.mapInArrow(segment_maps(ttl, width), "url string, run_us long, bin long, exit_bin long, path array<long>")
    runs = maps.repartition("url", "run_us").sortWithinPartitions("url", "run_us", "bin")
    taken = runs.mapInArrow(taken_paths, "url string, path array<long>")
    times = taken.select("url", F.explode("path").alias("expiry_us"))
    return stored(times.select("url", F.floor(F.col("expiry_us") / width).alias("bin"), "expiry_us"), "replay-expiries")


def changes(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Where a row of ``batch`` differs from the one before it in any of ``names``; the first row does."""
    out = np.zeros(batch.num_rows, bool)
    out[:1] = True
    for name in names:
        column = batch.column(name)
        out[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return out


def segment_maps(ttl: int, width: int):
    """For the first request of each bin of a segment: the chain's misses from
    there within the segment (``path``, at most one a TTL), and the bin in
    which its last probe finds no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, here = None, None
        chains: list[list[int]] = []  # of the segment; each ends with its latest miss
        out: list[tuple[str, int, list[int]]] = []

        def left(chain: list[int]) -> int:
            return (chain[-1] + ttl) // width  # the bin of the chain's probe

        def given() -> pa.RecordBatch:
            url, run_us, path = zip(*out, strict=True) if out else ((), (), ())
            columns = [pa.array(url, pa.string()), pa.array(run_us, pa.int64()), pa.array([p[0] // width for p in path], pa.int64()),
                       pa.array([left(p) for p in path], pa.int64()), pa.array(path, pa.list_(pa.int64()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["url", "run_us", "bin", "exit_bin", "path"])

        for batch in batches:
            us = batch.column("us").to_numpy()
            first = np.flatnonzero(changes(batch, ["url", "run_us", "place", "bin"])).tolist()
            urls, runs, places, bins = (batch.column(c).take(pa.array(first, pa.int64())).to_pylist() for c in ("url", "run_us", "place", "bin"))
            for i, (lo, hi) in enumerate(zip(first, [*first[1:], len(us)], strict=True)):
                own, new = (urls[i], runs[i], places[i]), False
                if own != segment:
                    out += [(segment[0], segment[1], c) for c in chains]
                    segment, chains, here = own, [], None
                if bins[i] != here:
                    here, new = bins[i], True
                    out += [(own[0], own[1], c) for c in chains if left(c) < here]
                    chains = [c for c in chains if left(c) >= here]
                for chain in chains:
                    if left(chain) == here and us[hi - 1] > chain[-1] + ttl:
                        chain.append(int(us[lo + np.searchsorted(us[lo:hi], chain[-1] + ttl, "right")]))
                if new:
                    chains.append([int(us[lo])])
            yield given()
        out += [(segment[0], segment[1], c) for c in chains]
        yield given()

    return run


def taken_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths a run's chain takes: that of its first bin, then always that
    of the first bin after the one the chain left from."""
    run, left = None, 0
    for batch in batches:
        taken = []
        keys = zip(batch.column("url").to_pylist(), batch.column("run_us").to_pylist(), strict=True)
        for i, (key, at, out) in enumerate(zip(keys, batch.column("bin").to_pylist(), batch.column("exit_bin").to_pylist(), strict=True)):
            if key != run or at > left:
                run, left = key, out
                taken.append(i)
        yield batch.select(["url", "path"]).take(pa.array(taken, pa.int64()))


def chain_starts(rows: DataFrame, part: str, ttl: int) -> tuple[DataFrame, DataFrame]:
    """The rows (column ``i``, their idx) that start anew: the first of every
    run, and from each start the run's first row more than ``ttl``
    microseconds later.  Also returns ``rows`` with the bounds of their run.

    ``rows`` has ``idx`` in (``part``, us, request_id) order and ``run``."""
    runs = rows.groupBy("run").agg(
        F.min("idx").alias("run_first"), F.max("idx").alias("run_last"),
        F.min("us").alias("run_t0"), F.max("us").alias("run_t1"),
    )

    # nxt(i): first row after ts_i + TTL, found by counting data rows that
    #    sort before the probe (part, ts_i + TTL) in the same global order.
    data = rows.select(part, "us", F.lit(0).alias("kind"), "request_id", F.lit(None).cast("bigint").alias("probe_of"))
    probes = rows.select(
        part, (F.col("us") + ttl).alias("us"), F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("request_id"), F.col("idx").alias("probe_of"),
    )
    both = data.unionByName(probes)
    counted = prefix_scan(both, [part, "us", "kind", "request_id"],
                          {"n_data": ("sum", (F.col("kind") == 0).cast("bigint"))})
    nxt = counted.where(F.col("kind") == 1).select(F.col("probe_of").alias("idx"), F.col("n_data").alias("nxt"))
    rows = rows.join(nxt, "idx").join(runs.select("run", "run_last", "run_first"), "run")
    rows = cut_lineage(rows.withColumn("nxt", F.when(F.col("nxt") <= F.col("run_last"), F.col("nxt"))))

    # The chain from each run start by pointer doubling
    bound = runs.agg(
        F.max(F.least(F.col("run_last") - F.col("run_first") + 1,
                      F.floor((F.col("run_t1") - F.col("run_t0")) / F.lit(ttl)) + 1))
    ).first()[0] or 1
    steps = max(1, math.ceil(math.log2(bound + 1)))
    # The jump table is kept bucketed by its source index, so each round
    # shuffles only the chain (for the reach join) and the jump table's
    # targets (for the composition), not the bucketed side.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    jump = bucketed_table(
        rows.where(F.col("nxt").isNotNull()).select(F.col("idx").alias("i"), F.col("nxt").alias("j")), "i", n, "jump")
    chain = runs.select(F.col("run_first").alias("i"))
    for _ in range(steps):
        reached = chain.join(jump, "i").select(F.col("j").alias("i"))
        chain = cut_lineage(chain.unionByName(reached).distinct())
        nxt2 = jump.alias("a").join(jump.alias("b"), F.col("a.j") == F.col("b.i")).select(
            F.col("a.i").alias("i"), F.col("b.j").alias("j"))
        previous = jump
        jump = bucketed_table(nxt2, "i", n, "jump")
        drop_bucketed(previous)
    drop_bucketed(jump)
    return chain, rows


def replay_summary(replayed: DataFrame) -> DataFrame:
    """Hits and misses (true savings: a hit is a fetch not paid for)."""
    return replayed.agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.count(F.lit(1)).alias("requests")
    )
