"""Derived views over the driver tables (FIXTURES.md part B).

Each view is a projection of one or two given tables, so its size grows
with them.  The expressions are the fixture definitions; the same texts
appear as CTEs in the DuckDB oracle (``webledger.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.sources.tables import read_table


class Views:
    """Lazily built fixture views for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            builder = globals().get(f"_view_{name}")
            if builder is None:
                raise AttributeError(name)
            self._cache[name] = builder(self)
        return self._cache[name]


def _rows_of(v: Views, name: str):
    """The number of rows of a given table, as a scalar subquery."""
    return v.table(name).agg(F.count(F.lit(1))).scalar()


def _view_requests(v: Views) -> DataFrame:
    # Requests are spread over every captured page and every key, so both grow with the data.
    spread = {
        "page_id": (F.col("request_id") * 7919 + F.col("page_no")) % _rows_of(v, "pages"),
        "key_id": F.col("account_id") % _rows_of(v, "supplier"),
    }
    return v.table("events").selectExpr(
        "event_id as request_id",
        "ts",
        "user_id as account_id",
        """case event_type when 'view' then 'scrape' when 'click' then 'map' when 'purchase' then 'crawl'
             when 'signup' then 'search' else 'interact' end as tool""",
        "cast(floor(value) as int) + 1 as n",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as page_no",
        "case cast(event_id % 4 as int) when 0 then 'json' when 1 then 'screenshot' else 'markdown' end as format",
        "event_id % 3 = 0 as with_scrape",
        """case when event_id % 13 = 0 then 429 when event_id % 97 = 0 then 500 when event_id % 17 = 5 then 201
             when event_id % 17 = 9 then 204 else 200 end as http_status""",
        """case when event_id % 26 = 0 then 'Monthly usage limit reached' when event_id % 13 = 0 then 'rate limited'
             when event_id % 17 = 9 then '' when event_id % 19 = 7 then '{"ok":true,"ok":false}'
             when event_id % 97 = 0 then null else '{"ok":true}' end as body""",
    ).withColumns(spread).drop("page_no")


def _view_keys(v: Views) -> DataFrame:
    return v.table("supplier").selectExpr(
        "s_suppkey as key_id",
        "s_nationkey as account_id",
        "s_name as name",
        "concat('wk-', repeat(cast(s_suppkey % 10 as string), 6), '-', cast(s_suppkey + 100000 as string)) as key_text",
        "cast(s_suppkey % 5 + 1 as int) as priority",
        "case when s_suppkey % 7 = 0 then null else cast(5000 as bigint) end as monthly_quota",
        "case when s_suppkey % 9 = 0 then null else cast(floor(s_acctbal) as bigint) end as remaining_credits",
        "cast(s_suppkey * 137 % 6000 as bigint) as used_credits",
        """case when s_suppkey % 4 = 0 then '' else concat('2024-01-', cast(10 + s_suppkey % 20 as string),
             'T00:00:00.000Z') end as last_checked""",
        "s_suppkey % 11 = 0 as disabled",
    )


def _view_accounts(v: Views) -> DataFrame:
    return v.table("customer").selectExpr(
        "c_custkey as account_id",
        "c_nationkey as nation_id",
        "c_mktsegment as plan",
        "cast(floor(c_acctbal) as bigint) as monthly_budget",
    )


def _view_jobs(v: Views) -> DataFrame:
    return v.table("orders").selectExpr(
        "o_orderkey as job_id", "o_custkey as account_id", "o_orderdate as started_at", "o_orderpriority as priority"
    )


def _view_job_pages(v: Views) -> DataFrame:
    return v.table("lineitem").selectExpr(
        "l_orderkey as job_id",
        "l_linenumber as page_no",
        "l_partkey as page_ref",
        "case l_linestatus when 'F' then 'completed' else 'pending' end as status",
        "cast(l_quantity as bigint) as credits",
        "l_shipdate as updated_at",
    )


def _view_capture_v1(v: Views) -> DataFrame:
    return v.table("pages").where("page_id % 10 <> 9").select("page_id", "url", "html")


def _view_capture_v2(v: Views) -> DataFrame:
    return (
        v.table("pages")
        .where("page_id % 10 <> 0")
        .selectExpr(
            "page_id",
            "url",
            "case when page_id % 5 = 1 then replace(html, '<h1>', '<h1>Updated ') else html end as html",
        )
    )


def _view_link_edges(v: Views) -> DataFrame:
    # Each page links to its two children in a binary tree: an equi join on
    # the parent id, no range or cross join.
    pages = v.table("pages").select("page_id")
    child = pages.where("page_id >= 1").select(
        F.col("page_id").alias("dst"), F.floor((F.col("page_id") - 1) / 2).cast("bigint").alias("parent")
    )
    return child.join(pages, child.parent == pages.page_id).select(F.col("page_id").alias("src"), "dst")


# The goal templates of the ``goals`` fixture, in order.
GOAL_TEMPLATES = [
    (0, "List all URLs of"),
    (1, "Find reviews about"),
    (2, "Watch prices in"),
    (3, "Upload the PDF for"),
    (4, "Extract from this page"),
    (5, "Get blog posts from"),
    (6, "monitor and find news on"),
    (7, "all pages to watch in"),
]


def _view_goals(v: Views) -> DataFrame:
    # The eight templates are a literal array exploded per nation row (no join).
    templates = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("txt")) for i, t in GOAL_TEMPLATES])
    return (
        v.table("nation")
        .select("n_nationkey", "n_name", F.explode(templates).alias("t"))
        .select(
            (F.col("n_nationkey") * 10 + F.col("t.i")).alias("goal_id"),
            F.concat(F.col("t.txt"), F.lit(" "), F.col("n_name")).alias("goal"),
        )
    )


def _view_intents(v: Views) -> DataFrame:
    """Goals to route: the templated goals plus every user turn of the
    conversations (which grows with the data)."""
    templated = v.goals.select(F.col("goal_id").cast("bigint").alias("goal_id"), "goal",
                               F.lit("template").alias("source"))
    turns = v.table("conversations").where(F.col("role") == "user").select(
        (F.lit(1_000_000) + F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("goal_id"),
        F.col("text").alias("goal"), F.lit("conversation").alias("source"),
    )
    return templated.unionByName(turns)


def _view_monitors(v: Views) -> DataFrame:
    return v.table("customer").selectExpr(
        "c_custkey as monitor_id",
        "concat('m-', c_name) as name",
        "c_mktsegment as goal_topic",
        "cast(30 + 30 * (c_custkey % 4) as int) as every_minutes",
        "case cast(c_custkey % 3 as int) when 0 then 'scrape' when 1 then 'crawl' else 'search' end as target_type",
        "cast(1 + c_custkey % 365 as int) as retention_days",
    )


def _view_search_queries(v: Views) -> DataFrame:
    return v.table("benchmark").selectExpr(
        "item_id as query_id", "lower(text) as query"
    )


def _view_checks(v: Views) -> DataFrame:
    return v.table("orders").selectExpr(
        "o_orderkey as check_id",
        "o_custkey as monitor_id",
        "o_orderdate as checked_at",
        "case o_orderstatus when 'F' then 'same' when 'O' then 'changed' else 'new' end as outcome",
    )


# Views of our own, derived by rule from the given tables ---------------------


def _view_attempts(v: Views) -> DataFrame:
    """Call attempts: every request is a first try; a 429 is retried once on the
    next key of the ring of all keys, and that retry fails with 500 when
    ``request_id % 3 = 0``.  The retries are made up by rule: no given table has any."""
    r = v.requests
    first = r.selectExpr(
        "request_id", "1 as attempt", "key_id", "http_status", "body", "ts"
    )
    retry = r.where("http_status = 429").selectExpr(
        "request_id",
        "2 as attempt",
        "key_id + 1 as key_id",
        "case when request_id % 3 = 0 then 500 else 200 end as http_status",
        """case when request_id % 3 = 0 then 'server error' else '{"ok":true}' end as body""",
        "ts",
    ).withColumn("key_id", F.col("key_id") % _rows_of(v, "supplier"))
    return first.unionByName(retry)


def _view_key_feed(v: Views) -> DataFrame:
    """Quota feed per key, one answer per supplier; some answers are errors,
    some keys are new to the ledger."""
    return v.table("supplier").selectExpr(
        "concat('wk-', repeat(cast(s_suppkey % 10 as string), 6), '-', cast(s_suppkey + 100000 + "
        "case when s_suppkey % 6 = 0 then 50000 else 0 end as string)) as key_text",
        "case when s_suppkey % 8 = 3 then null else cast(floor(s_acctbal) + 1000 as bigint) end as remaining_credits",
        "case when s_suppkey % 5 = 2 then null when s_suppkey % 5 = 4 then cast(0 as bigint) "
        "else cast(6000 as bigint) end as plan_credits",
        "case when s_suppkey % 10 = 7 then 'HTTP 401' else null end as error",
    )


def _view_key_candidates(v: Views) -> DataFrame:
    """Keys offered for addition: one per customer, pooled by nation."""
    return v.table("customer").selectExpr(
        "c_custkey as candidate_id",
        "c_nationkey as account_id",
        "concat('wk-', repeat(cast(c_custkey % 10 as string), 6), '-', cast(c_custkey % 400 + 100000 as string)) as key_text",
        "case when c_custkey % 3 = 0 then null else cast(floor(abs(c_acctbal)) as bigint) end as plan_credits",
        "case when c_custkey % 5 = 0 then null else cast(floor(abs(c_acctbal)) div 2 as bigint) end as remaining_credits",
        "case when c_custkey % 11 = 4 then 'HTTP 401' else null end as quota_error",
    )


def _view_key_removals(v: Views) -> DataFrame:
    """Names to remove, per pool: one per customer, pointing at a supplier name."""
    return v.table("customer").selectExpr(
        "c_nationkey as account_id",
        "concat('Supplier#', lpad(cast(c_custkey % 200 as string), 9, '0')) as name",
    )
