"""Set operations on tool selections and capture URL sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webledger.operators.cost import canonical_tools


def merge_selections(other: Column, selected: Column) -> Column:
    """Union preserving first-seen order, duplicates removed."""
    return F.array_distinct(F.concat(other, selected))


def order_selection(selected: Column) -> Column:
    """Intersection with the canonical tool list, in canonical order."""
    return canonical_tools(selected)


def first_use_order(df: DataFrame, group: str, item: str, ts: str, out: str) -> DataFrame:
    """Items per group ordered by first use (ties by name).  One row per
    (group, item) feeds the collect, so the array is bounded by the number
    of distinct items, not by the log."""
    firsts = df.groupBy(group, item).agg(F.min(ts).alias("_first"))
    return firsts.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("_first"), F.col(item)))), lambda s: s[item]).alias(out)
    )


def url_overlap(a: DataFrame, b: DataFrame, how: str, url: str = "url") -> DataFrame:
    """URLs in both captures (``both``), only in the first (``only_a``),
    only in the second (``only_b``) or in either (``either``), as sets."""
    ua, ub = a.select(url), b.select(url)
    if how == "both":
        return ua.intersect(ub)
    # Set semantics (EXCEPT DISTINCT): a URL present in both captures is in
    # neither "only" set, however often it repeats on one side.
    if how == "only_a":
        return ua.subtract(ub)
    if how == "only_b":
        return ub.subtract(ua)
    if how == "either":
        return ua.union(ub).distinct()
    raise ValueError(how)
