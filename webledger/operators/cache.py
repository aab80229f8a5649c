"""24-hour URL cache: lookup, write-back, statistics and batch dedupe (K1, K3-K5).

The cache is a table unique on ``url``.  Writes are a latest-per-key merge
(``max_by`` on a (time, id) ordering), which aggregates map-side, so a URL
written a billion times still costs one bounded partial aggregate per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webledger.functions.exprs import iso_millis, num_text

CACHE_TTL_HOURS = 24
DEFAULT_FORMAT = "markdown"

# The texts of the cache's verdicts.
NOT_CACHED = "URL not cached"
EXPIRED = "Cache expired"
OTHER_FORMAT = "Different format requested (cached: %s, requested: %s)"
ALREADY = "Already scraped %s at %s (%s credits saved)"


def verdict_text(missing: Column, expired: Column, other_format: Column, cached_format: Column, wanted: Column,
                 tool: Column, cached_at: Column, credits: Column) -> Column:
    """The verdict on one request, tested in this order."""
    return (
        F.when(missing, F.lit(NOT_CACHED))
        .when(expired, F.lit(EXPIRED))
        .when(other_format, F.format_string(OTHER_FORMAT, cached_format, wanted))
        .otherwise(F.format_string(ALREADY, tool, iso_millis(cached_at), num_text(credits)))
    )


def record_fetches(fetches: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """K3: last write per URL wins whatever its format; ``credits_written``
    sums every write, as the running total does.

    ``fetches``: url, tool, format, ts, credits, request_id.  An existing
    ``cache`` (same columns, ``cached_at`` for ts) is merged underneath; its
    rows are no writes and add nothing to the counts.
    """
    writes = fetches.select(
        "url", "tool", F.coalesce("format", F.lit(DEFAULT_FORMAT)).alias("format"),
        F.col("ts").alias("cached_at"), F.col("credits").cast("bigint").alias("credits"),
        F.col("request_id").cast("bigint").alias("write_id"),
    )
    if cache is not None:
        old = cache.select(
            "url", "tool", "format", "cached_at", "credits",
            F.lit(None).cast("bigint").alias("write_id"),
        )
        writes = old.unionByName(writes)
    order = F.struct("cached_at", F.coalesce("write_id", F.lit(-1)))
    last = F.max_by(F.struct("tool", "format", "cached_at", "credits"), order)
    return (
        writes.groupBy("url")
        .agg(
            last.alias("e"), F.count("write_id").alias("n_writes"),
            F.coalesce(F.sum(F.when(F.col("write_id").isNotNull(), F.col("credits"))), F.lit(0)).alias("credits_written"),
        )
        .select("url", "e.tool", "e.format", "e.cached_at", "e.credits", "n_writes", "credits_written")
    )


def cache_lookup(probes: DataFrame, cache: DataFrame, as_of: Column, fmt: Column | None = None) -> DataFrame:
    """K1: the fetch/skip verdict per probe, tested in the reference's order:
    not cached, expired (older than 24 h; exactly 24 h is fresh), different
    format, else skip."""
    c = cache.select(
        F.col("url").alias("_c_url"), F.col("tool").alias("_c_tool"), F.col("format").alias("_c_format"),
        F.col("cached_at").alias("_c_at"), F.col("credits").alias("_c_credits"),
    )
    want = F.coalesce(fmt if fmt is not None else F.col("format"), F.lit(DEFAULT_FORMAT))
    joined = probes.withColumn("_as_of", as_of).withColumn("_want", want).join(
        c, F.col("url") == F.col("_c_url"), "left"
    )
    missing = F.col("_c_url").isNull()
    expired = F.col("_as_of") > F.col("_c_at") + F.expr(f"INTERVAL {CACHE_TTL_HOURS} HOURS")
    other_fmt = F.col("_c_format") != F.col("_want")
    reason = verdict_text(missing, expired, other_fmt, F.col("_c_format"), F.col("_want"), F.col("_c_tool"),
                          F.col("_c_at"), F.col("_c_credits"))
    skip = ~(missing | expired | other_fmt)
    return joined.withColumns({"skip": skip, "cache_reason": reason}).drop(
        "_c_url", "_c_tool", "_c_format", "_c_at", "_c_credits", "_as_of", "_want"
    )


def cache_stats(cache: DataFrame) -> DataFrame:
    """K4: URL count, credits (spent, as the reference sums them), oldest and
    newest entry; an empty cache gives 0, 0, null, null."""
    return cache.agg(
        F.count(F.lit(1)).alias("total_urls"),
        F.coalesce(F.sum("credits"), F.lit(0)).cast("bigint").alias("total_credits_saved"),
        F.min("cached_at").alias("oldest_entry"),
        F.max("cached_at").alias("newest_entry"),
    ).withColumn(
        "message",
        F.format_string("Cached %s URLs, saved %s credits", num_text(F.col("total_urls")),
                        num_text(F.col("total_credits_saved"))),
    )


def dedupe_batch(requests: DataFrame, batch: Column, key_cols: list[str]) -> DataFrame:
    """K5: within a batch fetch each (URL, format) once; every request is
    joined back to the request that fetches for it.

    The first request per key comes from a partial aggregate; the join back
    is an equi join on the key, split by AQE when one key is hot.
    """
    keyed = requests.withColumn("batch", batch)
    first = keyed.groupBy("batch", *key_cols).agg(F.min("request_id").alias("fetched_by"))
    return keyed.join(first, ["batch", *key_cols]).withColumn(
        "is_fetch", F.col("request_id") == F.col("fetched_by")
    )
