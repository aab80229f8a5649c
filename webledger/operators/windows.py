"""Skew-safe running totals and prefix scans.

A plain ``sum(...) over (partition by account order by ts)`` puts every row
of an account into one task; when one account holds a third of the log that
task is the job.  ``prefix_scan`` computes global prefix aggregates over a
range-partitioned order, and ``running_sum`` derives per-key running sums
from it, so no key is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def chunked_running_sum(
    df: DataFrame,
    part: list[str],
    order: list[str],
    value: str,
    chunk: dict[str, Column],
    out: str = "running",
    carry: tuple[DataFrame, list[str]] | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` over ``order`` within ``part``, in
    two levels and with one shuffle of the rows.

    ``chunk`` (name -> column) cuts each part into stretches of its order, say
    the hour of a time that leads ``order``.  Totals per (part, chunk) are a
    partial aggregate; their exclusive prefix within a part runs over one row
    per chunk.  The rows are dealt by (part, chunk), so a part that holds a
    third of them is spread over its chunks, and a window inside the chunk adds
    up the rest.  ``carry`` joins a table with one row per key to the chunk
    totals, so its columns reach the rows without another shuffle of them.
    Parts and chunks that are null are left out.
    """
    keys = [*part, *chunk]
    tagged = df.withColumns(chunk)
    totals = tagged.groupBy(*keys).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*part).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    if carry is not None:
        offsets = offsets.join(carry[0], carry[1], "left")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = tagged.withColumn("_inside", F.sum(value).over(inside)).join(offsets, keys)
    return summed.withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside", *chunk)


def running_sums(
    df: DataFrame,
    part: list[str],
    order: list[Column | str],
    values: dict[str, Column | str],
) -> DataFrame:
    """Inclusive running sums of several ``values`` (output name -> column)
    over ``order`` within ``part``, from one prefix scan.  Where the order is
    led by something that cuts into chunks, ``chunked_running_sum`` moves less.

    ``part`` + ``order`` must be a total order (end ``order`` with a unique
    id).  One global prefix sum per value runs over the whole table in that
    order (``prefix_scan``: range-partitioned, so a key holding a third of
    the rows is spread over many tasks); a key's running sum is the global
    one minus the global sum just before the key's first row, a per-key
    minimum that aggregates map-side.
    """
    tagged = df
    names = []
    for i, o in enumerate(order):
        if isinstance(o, str):
            names.append(o)
        else:
            tagged = tagged.withColumn(f"_o{i}", o)
            names.append(f"_o{i}")
    vals = {}
    for k, c in values.items():
        tagged = tagged.withColumn(f"_v_{k}", F.col(c) if isinstance(c, str) else c)
        vals[f"_g_{k}"] = ("sum", F.col(f"_v_{k}"))
    scanned = prefix_scan(tagged, [*part, *names], vals)
    offsets = scanned.groupBy(*part).agg(
        *[F.min(F.col(f"_g_{k}") - F.col(f"_v_{k}")).alias(f"_b_{k}") for k in values]
    )
    out = scanned.join(offsets, part)
    for k in values:
        out = out.withColumn(k, F.col(f"_g_{k}") - F.col(f"_b_{k}"))
    drop = [c for k in values for c in (f"_v_{k}", f"_g_{k}", f"_b_{k}")] + [n for n in names if n.startswith("_o")]
    return out.drop(*drop)


def running_sum(
    df: DataFrame,
    part: list[str],
    order: list[Column | str],
    value: Column | str,
    out: str = "running",
) -> DataFrame:
    """One running sum (see ``running_sums``)."""
    return running_sums(df, part, order, {out: value})


def prefix_scan(df: DataFrame, order: list[str], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Global inclusive prefix aggregates over a total ``order``, skew-free.

    ``values`` maps an output name to ("sum" | "max", column).  The rows are
    range-partitioned by the full order (a hot key spans many partitions),
    numbered inside each partition, and materialised once so that the
    partition boundaries stay fixed.  (A table bucketed by partition id would
    save the window's shuffle, but its write costs more than the shuffle at
    the sizes measured here.)  Per-partition totals form a table with
    one row per partition - bounded by the partition count, hence broadcast -
    whose exclusive prefix is added to a window that runs inside one
    partition.
    """
    from webledger.session import cut_lineage

    cols = {f"_v_{k}": c for k, (_, c) in values.items()}
    s = df.withColumns(cols).orderBy(*order)
    s = cut_lineage(s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    aggs = []
    for k, (how, _) in values.items():
        fn = F.sum if how == "sum" else F.max
        aggs.append(fn(f"_v_{k}").alias(f"_p_{k}"))
    parts = s.groupBy("_pid").agg(*aggs)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(
        "_pid",
        *[
            (F.sum if how == "sum" else F.max)(f"_p_{k}").over(before).alias(f"_c_{k}")
            for k, (how, _) in values.items()
        ],
    )
    inside = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(carry), "_pid")
    for k, (how, _) in values.items():
        if how == "sum":
            expr = F.coalesce(F.col(f"_c_{k}"), F.lit(0)) + F.sum(f"_v_{k}").over(inside)
        else:
            expr = F.greatest(F.col(f"_c_{k}"), F.max(f"_v_{k}").over(inside))
        out = out.withColumn(k, expr)
    drop = ["_pid", "_mid"] + [f"_v_{k}" for k in values] + [f"_c_{k}" for k in values]
    return out.drop(*drop)
