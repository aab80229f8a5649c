"""Response bodies and request parameters as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_payloads(responses: DataFrame, body: str = "body") -> DataFrame:
    """Lenient parse.  Null or empty -> empty object, valid JSON -> a
    variant (of repeated keys the last counts, which this sets for the
    session), anything else stays raw text."""
    responses.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    b = F.col(body)
    parsed = F.try_parse_json(b)
    kind = (
        F.when(b.isNull() | (b == ""), F.lit("empty"))
        .when(parsed.isNotNull(), F.lit("json"))
        .otherwise(F.lit("text"))
    )
    return responses.withColumns(
        {
            "payload": F.when(kind == "empty", F.parse_json(F.lit("{}"))).otherwise(parsed),
            "payload_kind": kind,
            "raw_text": F.when(kind == "text", b),
        }
    )


def payload_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("payload_kind").agg(F.count(F.lit(1)).alias("bodies"))


def explicit_null() -> Column:
    """A JSON ``null`` that survives cleaning: a VARIANT null is a value, not
    an absent field, so ``to_json`` keeps it."""
    return F.parse_json(F.lit("null"))


def compact_params(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Parameters as JSON with absent fields omitted at every depth, like
    the reference's cleaning step: ``to_json`` drops SQL-NULL struct fields,
    keeps array slots (as ``null``) and keeps ``explicit_null()`` values."""
    return df.withColumn("params_json", F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])))


def merge_latest(current: DataFrame, updates: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Updated keys replace, others stay.  Latest row per key by ``order``
    (updates win ties), as one partial aggregate instead of a sort per key."""
    cols = [c for c in current.columns]
    tagged = current.select(*cols, F.lit(0).alias("_src")).unionByName(
        updates.select(*cols, F.lit(1).alias("_src"))
    )
    value_cols = [c for c in cols if c not in key]
    ordering = F.struct(*[F.col(o) for o in order], F.col("_src"))
    latest = F.max_by(F.struct(*value_cols), ordering)
    return tagged.groupBy(*key).agg(latest.alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


# The endpoint of each tool.
TOOL_PATHS = {
    "scrape": "/scrape",
    "crawl": "/crawl",
    "map": "/map",
    "search": "/search",
    "parse": "/parse",
    "interact": "/interact",
    "monitor_create": "/monitor",
}


def request_paths(calls: DataFrame) -> DataFrame:
    """API path per call: ``tool``, optional ``id``, ``limit``, ``offset``.
    Ids are percent-encoded; a zero or missing limit/offset is not sent, and
    the query string appears only when something is."""
    from webledger.functions.urls import encode_component

    tool = F.col("tool")
    truthy = lambda c: F.col(c).isNotNull() & (F.col(c) != 0)
    qs = F.concat_ws(
        "&",
        F.when(truthy("limit"), F.concat(F.lit("limit="), F.col("limit").cast("bigint").cast("string"))),
        F.when(truthy("offset"), F.concat(F.lit("offset="), F.col("offset").cast("bigint").cast("string"))),
    )
    query = F.when(qs != "", F.concat(F.lit("?"), qs)).otherwise(F.lit(""))
    eid = encode_component(F.col("id"))
    fixed = F.lit(None).cast("string")
    for name, p in reversed(list(TOOL_PATHS.items())):
        fixed = F.when(tool == name, F.lit(p)).otherwise(fixed)
    path = (
        F.when(tool == "crawl_status", F.concat(F.lit("/crawl/"), eid))
        .when(tool == "monitor_list", F.concat(F.lit("/monitor"), query))
        .when(tool == "monitor_checks", F.concat(F.lit("/monitor/"), eid, F.lit("/checks"), query))
        .otherwise(fixed)
    )
    return calls.withColumn("path", path)
