"""Credit metering: estimates, routing, budgets and spend reports.

Every estimate is a column expression, so a whole request log is priced in
one projection inside whole-stage codegen; reports are partial (map-side)
aggregates, which keeps a hot account from landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webledger.functions.exprs import js_ceil_div, js_round, num_text

# Credit rates per tool, as the reference prices them.
BASE_CREDITS = {
    "scrape": 1,
    "crawl": 1,
    "map": 1,
    "parse": 1,
    "interact": 2,
    "monitor_create": 1,
    "monitor_list": 0,
    "monitor_checks": 0,
    "crawl_status": 0,
    "optimize": 0,
}
JSON_SURCHARGE = 4
SCREENSHOT_SURCHARGE = 1
ENHANCED_SURCHARGE = 4
DEFAULT_CRAWL_LIMIT = 100
DEFAULT_SEARCH_LIMIT = 10
DEFAULT_INTERACT_TTL = 300

# Canonical tool order.
TOOL_ORDER = [
    "scrape",
    "crawl",
    "crawl_status",
    "map",
    "search",
    "parse",
    "interact",
    "monitor_create",
    "monitor_list",
    "monitor_checks",
    "optimize",
]

# Goal routing rules, tested in order on the lower-cased goal.
ROUTING_RULES = [
    ("map", ["all pages", "every page", "site map", "list all urls"],
     "Map discovers all URLs for 1 credit. Scrape only what you need after."),
    ("search", ["search", "find", "discover", "look for"],
     "Search discovers relevant pages. Scrape only top results after."),
    ("monitor_create", ["monitor", "watch", "notify", "alert", "track changes"],
     "Monitor checks automatically and only charges for actual changes."),
    ("parse", ["pdf", "docx", "xlsx", "local file", "upload"],
     "Parse handles local files directly."),
    ("scrape", ["scrape", "this url", "this page", "extract from"],
     "Scrape is the cheapest for single URLs. Markdown format (no JSON surcharge)."),
]
# How the message on a cache verdict starts.
SKIP, FETCH = "SKIP: ", "FETCH: "
DEFAULT_ROUTE = ("scrape", "Default: scrape with markdown format (1 credit, no surcharges).")

LIGHT_TOOLS = ["scrape", "crawl", "search", "map"]


def base_credits(tool: Column) -> Column:
    expr = F.lit(1)
    for name, credits in reversed(list(BASE_CREDITS.items())):
        expr = F.when(tool == name, F.lit(credits)).otherwise(expr)
    return expr


def request_params(requests: DataFrame) -> DataFrame:
    """Map the request log to tool parameters: ``n`` is the limit of crawl and
    search and the ttl of interact; one requested format per scrape."""
    return requests.withColumns(
        {
            "formats": F.when(F.col("tool") == "scrape", F.array("format")),
            "limit": F.when(F.col("tool").isin("crawl", "search"), F.col("n")),
            "ttl": F.when(F.col("tool") == "interact", F.col("n")),
        }
    )


def estimate_cost(df: DataFrame, enhanced: Column | None = None) -> DataFrame:
    """C1 + C2: credits, reason, cheaper alternative, savings and tip per row.

    Needs columns ``tool, formats, limit, ttl, with_scrape``.  ``enhanced``
    optionally adds the declared (never applied) enhanced surcharge.
    """
    tool = F.col("tool")
    # The rate is computed once per row, not inlined into every expression below.
    df = df.withColumn("_base", base_credits(tool))
    base = F.col("_base")
    fmts = F.coalesce(F.col("formats"), F.array(F.lit("markdown")))
    has_json = F.array_contains(fmts, "json")
    has_shot = F.array_contains(fmts, "screenshot")
    scrape_cost = (
        base
        + F.when(has_json, JSON_SURCHARGE).otherwise(0)
        + F.when(has_shot, SCREENSHOT_SURCHARGE).otherwise(0)
    )
    if enhanced is not None:
        scrape_cost = scrape_cost + F.when(enhanced, ENHANCED_SURCHARGE).otherwise(0)
    extras = F.concat_ws(", ", F.when(has_json, F.lit("+4 JSON")), F.when(has_shot, F.lit("+1 screenshot")))
    scrape_reason = F.when(extras != "", F.concat(num_text(base), F.lit(" base + "), extras)).otherwise(
        F.concat(num_text(scrape_cost), F.lit(" credit(s)"))
    )

    crawl_limit = F.coalesce(F.col("limit"), F.lit(DEFAULT_CRAWL_LIMIT))
    crawl_cost = crawl_limit * base
    # The reference multiplies in IEEE doubles; do the same rather than in decimals.
    crawl_saving = F.greatest(
        F.lit(0), crawl_cost - F.ceil(crawl_limit.cast("double") * F.lit(0.2)).cast("bigint") - 1
    )

    search_limit = F.coalesce(F.col("limit"), F.lit(DEFAULT_SEARCH_LIMIT))
    search_cost = js_ceil_div(search_limit, 10) * 2
    will_scrape = F.coalesce(F.col("with_scrape"), F.lit(False))
    search_scrape = F.when(will_scrape, search_limit).otherwise(0)
    search_total = search_cost + search_scrape

    ttl = F.coalesce(F.col("ttl"), F.lit(DEFAULT_INTERACT_TTL))
    minutes = js_ceil_div(ttl, 60)
    interact_cost = minutes * base

    credits = (
        F.when(tool == "scrape", scrape_cost)
        .when(tool == "crawl", crawl_cost)
        .when(tool == "search", search_total)
        .when(tool == "map", 1)
        .when(tool == "interact", interact_cost)
        .otherwise(base)
    ).cast("bigint")
    reason = (
        F.when(tool == "scrape", scrape_reason)
        .when(
            tool == "crawl",
            F.format_string("%s pages x %s credit(s) = %s credits", num_text(crawl_limit), num_text(base),
                            num_text(crawl_cost)),
        )
        .when(
            tool == "search",
            F.when(
                will_scrape,
                F.format_string("%s search + %s scrape = %s credits", num_text(search_cost), num_text(search_scrape),
                                num_text(search_total)),
            ).otherwise(F.format_string("%s credits (no scraping)", num_text(search_cost))),
        )
        .when(tool == "map", F.lit("1 credit for URL discovery"))
        .when(
            tool == "interact",
            F.format_string("%s min x %s credits/min = %s credits", num_text(minutes), num_text(base),
                            num_text(interact_cost)),
        )
        .when(tool == "parse", F.lit("1 credit per page"))
        .otherwise(F.concat(num_text(base), F.lit(" credit(s)")))
    )
    alternative = (
        F.when(tool == "scrape", F.lit("map + scrape"))
        .when(tool == "crawl", F.lit("map + selective scrape"))
        .when((tool == "search") & will_scrape, F.lit("search without scrapeOptions"))
        .when(tool == "interact", F.lit("scrape with actions"))
    )
    savings = (
        F.when(tool == "scrape", F.greatest(F.lit(0), scrape_cost - 2))
        .when(tool == "crawl", crawl_saving)
        .when(tool == "search", search_scrape)
        .when(tool == "interact", F.greatest(F.lit(0), interact_cost - 1))
    ).cast("bigint")
    tip = F.when(
        alternative.isNotNull(),
        F.format_string("Consider using %s instead to save %s credits.", alternative, num_text(savings)),
    ).otherwise(F.lit("This is already the cheapest option."))
    return df.withColumns(
        {
            "estimated_credits": credits,
            "reason": reason,
            "cheaper_alternative": alternative,
            "alternative_savings": savings,
            "tip": tip,
        }
    ).drop("_base")


def priced_requests(requests: DataFrame) -> DataFrame:
    return estimate_cost(request_params(requests))


def route_goals(goals: DataFrame, goal_col: str = "goal") -> DataFrame:
    """Intent -> tool by ordered substring rules; first match wins."""
    low = F.lower(F.col(goal_col))
    tool = F.lit(DEFAULT_ROUTE[0])
    why = F.lit(DEFAULT_ROUTE[1])
    for name, words, text in reversed(ROUTING_RULES):
        hit = None
        for w in words:
            c = low.contains(w)
            hit = c if hit is None else (hit | c)
        tool = F.when(hit, F.lit(name)).otherwise(tool)
        why = F.when(hit, F.lit(text)).otherwise(why)
    return goals.withColumns({"recommended_tool": tool, "route_reason": why})


def plan_goals(goals: DataFrame, cache_status: DataFrame | None = None) -> DataFrame:
    """C4: route (``route_reason`` says why), then price the routed tool with
    no parameters beyond the URL; attach the cache verdict and its message
    when a ``cache_status`` (goal_id, skip, cache_reason) table is given."""
    routed = route_goals(goals)
    priced = estimate_cost(
        routed.withColumns(
            {
                "tool": F.col("recommended_tool"),
                "formats": F.lit(None).cast("array<string>"),
                "limit": F.lit(None).cast("int"),
                "ttl": F.lit(None).cast("int"),
                "with_scrape": F.lit(False),
            }
        )
    )
    if cache_status is not None:
        verdict = F.concat(F.when(F.col("skip"), SKIP).otherwise(FETCH), F.col("cache_reason"))
        priced = priced.join(cache_status, "goal_id", "left").withColumn("cache_message", verdict)
    return priced


def spend_cube(priced: DataFrame, dims: list[str], mode: str = "rollup") -> DataFrame:
    """Credits and calls by the given dimensions with subtotals."""
    grouped = priced.rollup(*dims) if mode == "rollup" else priced.cube(*dims)
    return grouped.agg(
        F.sum("estimated_credits").alias("credits"),
        F.count(F.lit(1)).alias("calls"),
        F.grouping_id().alias("gid"),
    )


def budget_status(priced: DataFrame, accounts: DataFrame) -> DataFrame:
    """Used vs budget per account; percentage rounds half up, 0 without a budget."""
    used = priced.groupBy("account_id").agg(F.sum("estimated_credits").alias("used"))
    b = F.col("monthly_budget")
    u = F.coalesce(F.col("used"), F.lit(0)).cast("bigint")
    pct = F.when(b > 0, js_round(u.cast("double") / b.cast("double") * 100)).otherwise(F.lit(0)).cast("bigint")
    out = accounts.select("account_id", "monthly_budget").join(used, "account_id", "left")
    return out.select(
        "account_id",
        u.alias("total_used"),
        b.alias("monthly_budget"),
        F.greatest(F.lit(0), b - u).cast("bigint").alias("remaining"),
        pct.alias("percentage"),
        F.when(b > 0, F.format_string("Used %s/%s credits (%s%%)", num_text(u), num_text(b), num_text(pct))).otherwise(
            F.lit("No budget set. Use setMonthlyBudget() to configure.")
        ).alias("message"),
    )


def reset_month(priced: DataFrame, url_of: Column) -> DataFrame:
    """Totals and the URL cache restart at each month start, so usage is
    kept per account-month; the cached-URL count is per month too."""
    month = F.date_trunc("month", F.col("ts")).cast("date")
    return (
        priced.withColumn("month", month)
        .withColumn("cache_url", url_of)
        .groupBy("account_id", "month")
        .agg(
            F.sum("estimated_credits").alias("used_in_month"),
            F.count_distinct("cache_url").alias("urls_cached"),
        )
    )


def set_budget(accounts: DataFrame, updates: DataFrame) -> DataFrame:
    """New budgets replace old ones by account; other accounts keep theirs
    and new accounts are added.  Of several updates of an account the last by
    ``updated_at`` counts, or the largest where there is no such column."""
    order = F.struct(*[c for c in ("updated_at", "monthly_budget") if c in updates.columns])
    upd = updates.groupBy("account_id").agg(F.max_by("monthly_budget", order).alias("new_budget"))
    return accounts.join(upd, "account_id", "full").withColumn(
        "monthly_budget", F.coalesce("new_budget", "monthly_budget")
    ).drop("new_budget")


def compare_strategies(pages: DataFrame, site: Column, wanted: Column) -> DataFrame:
    """Per site, crawl all n pages vs map + scrape k wanted vs map only."""
    per_site = pages.groupBy(site.alias("site")).agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(wanted).alias("wanted")
    )
    crawl = F.col("n_pages")
    map_scrape = F.col("wanted") + 1
    best = F.least(crawl, map_scrape)
    return per_site.select(
        "site",
        "n_pages",
        "wanted",
        crawl.alias("crawl_credits"),
        map_scrape.alias("map_scrape_credits"),
        F.lit(1).cast("bigint").alias("map_only_credits"),
        F.when(map_scrape < crawl, F.lit("map + scrape")).otherwise(F.lit("crawl")).alias("winner"),
        (F.greatest(crawl, map_scrape) - best).alias("saving"),
    )


def compare_interact(priced: DataFrame, needs_login: Column) -> DataFrame:
    """Interact at 2 credits per minute vs scrape with actions at 1 credit,
    where no login is needed; percentage saved rounds half up."""
    inter = priced.where(F.col("tool") == "interact")
    c = F.col("estimated_credits")
    login = F.coalesce(needs_login, F.lit(False))
    return inter.select(
        "request_id",
        c.alias("interact_credits"),
        F.when(login, F.lit(None)).otherwise(F.lit(1)).cast("bigint").alias("scrape_credits"),
        F.when(login, F.lit("interact")).otherwise(F.lit("scrape")).alias("winner"),
        F.when(login, F.lit(None))
        .otherwise(js_round((c - 1).cast("double") / c.cast("double") * 100))
        .cast("bigint")
        .alias("saving_pct"),
    )


def succeeded(status: Column) -> Column:
    """Any 2xx answer."""
    return (status >= 200) & (status < 300)


def credits_per_success(priced: DataFrame) -> DataFrame:
    """C11: total credits over successful calls, two decimals truncated;
    overall (tool null) and per tool."""
    agg = priced.rollup("tool").agg(
        F.sum("estimated_credits").alias("credits"),
        F.count_if(succeeded(F.col("http_status"))).alias("successes"),
    )
    ratio = F.when(
        F.col("successes") > 0, F.expr("(credits * 100) div successes").cast("double") / 100.0
    )
    return agg.select("tool", "credits", "successes", ratio.alias("credits_per_success"))


def increment_usage(calls: DataFrame, keys: DataFrame, unit: str = "request") -> DataFrame:
    """Add one per successful call (or its credits) to the key that
    served it, and note the last try of every key that was asked.

    ``calls`` has a row per try: key_id, http_status, ts, estimated_credits; a
    successful retry counts for the key it was made with.  A key without a
    usage row gets one at its first try."""
    amount = F.lit(1) if unit == "request" else F.col("estimated_credits")
    tried = calls.groupBy("key_id").agg(
        F.coalesce(F.sum(F.when(succeeded(F.col("http_status")), amount)), F.lit(0)).cast("bigint").alias("added"),
        F.max("ts").alias("last_try"),
    )
    ledger = keys.select("key_id", F.col("used_credits").alias("had"))
    used = F.coalesce(F.col("had"), F.lit(0))
    return ledger.join(tried, "key_id", "left").where(F.col("had").isNotNull() | F.col("last_try").isNotNull()).select(
        "key_id",
        used.cast("bigint").alias("used_credits"),
        F.coalesce("added", F.lit(0)).cast("bigint").alias("added"),
        (used + F.coalesce("added", F.lit(0))).cast("bigint").alias("new_used_credits"),
        "last_try",
    )


def distinct_urls(fetches: DataFrame, approximate: bool = False, rsd: float = 0.02) -> DataFrame:
    """Distinct URLs per account, exact or HyperLogLog++."""
    agg = (
        F.approx_count_distinct("url", rsd).alias("approx_urls")
        if approximate
        else F.count_distinct("url").alias("distinct_urls")
    )
    return fetches.groupBy("account_id").agg(agg)


#: log2 of the registers of a sketch: a standard error of 0.6 %.
SKETCH_LG_K = 15


def url_sketches(fetches: DataFrame, ts: str = "ts", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """C13, incremental: a mergeable sketch of the URLs of each account and day."""
    return fetches.groupBy("account_id", F.col(ts).cast("date").alias("day")).agg(F.hll_sketch_agg("url", lg_k).alias("urls"))


def add_sketches(sketches: DataFrame, more: DataFrame) -> DataFrame:
    """Stored sketches with those of further fetches merged in, day by day; what was counted before is not read again."""
    return sketches.unionByName(more).groupBy("account_id", "day").agg(F.hll_union_agg("urls").alias("urls"))


def distinct_urls_between(sketches: DataFrame, first: Column, last: Column) -> DataFrame:
    """About how many distinct URLs each account fetched from day ``first`` to day ``last``, from the sketches alone."""
    union = F.hll_union_agg("urls")
    return sketches.where(F.col("day").between(first, last)).groupBy("account_id").agg(F.hll_sketch_estimate(union).alias("approx_urls"))


def canonical_tools(tools: Column) -> Column:
    """Canonical ordered distinct subset of ``tools`` (set semantics)."""
    canon = F.array(*[F.lit(t) for t in TOOL_ORDER])
    return F.filter(canon, lambda t: F.array_contains(tools, t))


def tool_adoption(selections: DataFrame, account: str = "account_id", tool: str = "tool") -> DataFrame:
    """C14: per account the canonical ordered tool set, validity and status.

    ``collect_set`` holds at most the number of distinct names, so even an
    account with a third of all rows aggregates in bounded memory.
    """
    known = F.array(*[F.lit(t) for t in TOOL_ORDER])
    per = selections.groupBy(account).agg(F.collect_set(tool).alias("tool_set"))
    ordered = canonical_tools(F.col("tool_set"))
    n = F.size(ordered).cast("bigint")
    return per.select(
        account,
        F.array_join(ordered, ",").alias("tools"),
        n.alias("n_tools"),
        F.forall("tool_set", lambda t: F.array_contains(known, t)).alias("valid"),
        F.when(n == len(TOOL_ORDER), "enabled").when(n == 0, "disabled").otherwise("partial").alias("status"),
    )


def adoption_counts(adoption: DataFrame) -> DataFrame:
    return adoption.groupBy("status").agg(F.count(F.lit(1)).alias("accounts"))
