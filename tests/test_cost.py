"""Literal boundary cases for pricing, routing and budgets."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from webledger.operators import cost

SCHEMA = "tool string, formats array<string>, limit int, ttl int, with_scrape boolean"


def _price(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.tool + ":" + str(i): r for i, r in enumerate(cost.estimate_cost(df).collect())}


def test_estimates_follow_reference_cases(spark):
    rows = [
        ("scrape", None, None, None, None),
        ("scrape", ["json", "screenshot"], None, None, None),
        ("crawl", None, 15, None, None),
        ("crawl", None, 0, None, None),
        ("crawl", None, None, None, None),
        ("search", None, None, None, None),
        ("search", None, 25, None, True),
        ("map", None, None, None, None),
        ("interact", None, None, None, None),
        ("interact", None, 180, None, None),
        ("parse", None, None, None, None),
        ("monitor_list", None, None, None, None),
        ("optimize", None, None, None, None),
        ("unknown_tool", None, None, None, None),
    ]
    fixed = [(t, f, lim if t != "interact" else None, lim if t == "interact" else None, w) for t, f, lim, _, w in rows]
    out = list(_price(spark, fixed).values())
    got = [(r.estimated_credits, r.reason, r.cheaper_alternative, r.alternative_savings) for r in out]
    assert got == [
        (1, "1 credit(s)", "map + scrape", 0),
        (6, "1 base + +4 JSON, +1 screenshot", "map + scrape", 4),
        (15, "15 pages x 1 credit(s) = 15 credits", "map + selective scrape", 11),
        (0, "0 pages x 1 credit(s) = 0 credits", "map + selective scrape", 0),
        (100, "100 pages x 1 credit(s) = 100 credits", "map + selective scrape", 79),
        (2, "2 credits (no scraping)", None, 0),
        (31, "6 search + 25 scrape = 31 credits", "search without scrapeOptions", 25),
        (1, "1 credit for URL discovery", None, None),
        (10, "5 min x 2 credits/min = 10 credits", "scrape with actions", 9),
        (6, "3 min x 2 credits/min = 6 credits", "scrape with actions", 5),
        (1, "1 credit per page", None, None),
        (0, "0 credit(s)", None, None),
        (0, "0 credit(s)", None, None),
        (1, "1 credit(s)", None, None),
    ]
    tips = [r.tip for r in out]
    assert tips[0] == "Consider using map + scrape instead to save 0 credits."
    assert tips[5] == "This is already the cheapest option."


def test_routing_first_match_wins(spark):
    goals = spark.createDataFrame(
        [(1, "List all URLs of docs"), (2, "find and monitor prices"), (3, "Upload the PDF"),
         (4, "get all blog posts from example.com"), (5, "Extract from this page"), (6, "track changes")],
        "goal_id int, goal string",
    )
    got = {r.goal_id: r.recommended_tool for r in cost.route_goals(goals).collect()}
    assert got == {1: "map", 2: "search", 3: "parse", 4: "scrape", 5: "scrape", 6: "monitor_create"}


def test_budget_rounds_half_up_and_handles_no_budget(spark):
    priced = spark.createDataFrame(
        [Row(account_id=1, estimated_credits=1), Row(account_id=2, estimated_credits=250),
         Row(account_id=3, estimated_credits=5)]
    )
    accounts = spark.createDataFrame(
        [Row(account_id=1, monthly_budget=200), Row(account_id=2, monthly_budget=200),
         Row(account_id=3, monthly_budget=0), Row(account_id=4, monthly_budget=10)]
    )
    got = {r.account_id: r for r in cost.budget_status(priced, accounts).collect()}
    assert (got[1].percentage, got[1].remaining) == (1, 199)  # 0.5% rounds up
    assert (got[2].percentage, got[2].remaining) == (125, 0)  # may exceed 100
    assert got[3].message == "No budget set. Use setMonthlyBudget() to configure."
    assert (got[4].total_used, got[4].message) == (0, "Used 0/10 credits (0%)")


def test_credits_per_success_truncates(spark):
    # The benchmark script: 17 credits over 10 successes -> 1.70
    rows = [Row(tool="t", estimated_credits=c, http_status=200) for c in [1, 1, 1, 2, 2, 3, 5, 1, 1, 0]]
    out = cost.credits_per_success(spark.createDataFrame(rows)).where(F.col("tool").isNull()).first()
    assert (out.credits, out.successes, out.credits_per_success) == (17, 10, 1.7)
    rows = [Row(tool="t", estimated_credits=c, http_status=200) for c in [1, 1, 0]]
    out = cost.credits_per_success(spark.createDataFrame(rows)).where(F.col("tool").isNull()).first()
    assert out.credits_per_success == 0.66  # 2 / 3 truncated, not rounded


def test_tool_adoption_status(spark):
    rows = [Row(account_id=1, tool=t) for t in cost.TOOL_ORDER] + [Row(account_id=2, tool="search"),
                                                                  Row(account_id=2, tool="scrape"),
                                                                  Row(account_id=2, tool="bad")]
    got = {r.account_id: r for r in cost.tool_adoption(spark.createDataFrame(rows)).collect()}
    assert got[1].status == "enabled" and got[1].valid
    assert got[2].tools == "scrape,search" and got[2].status == "partial" and not got[2].valid


def test_increment_usage_counts_any_2xx_for_the_key_that_served(spark):
    calls = spark.createDataFrame([
        (1, 200, 10, 5), (1, 429, 11, 5), (2, 204, 12, 5), (2, 500, 13, 3), (9, 200, 14, 1), (3, 500, 15, 1)],
        "key_id long, http_status int, ts int, estimated_credits long")
    keys = spark.createDataFrame([(1, 10), (2, None), (3, None), (4, 7), (5, None)], "key_id long, used_credits long")
    got = {r.key_id: (r.used_credits, r.added, r.new_used_credits, r.last_try) for r in cost.increment_usage(calls, keys).collect()}
    # Keys 2 and 3 get a row at their first try, 4 was not asked, 5 has no row, 9 is unknown.
    assert got == {1: (10, 1, 11, 11), 2: (0, 1, 1, 13), 3: (0, 0, 0, 15), 4: (7, 0, 7, None)}
    got = {r.key_id: r.new_used_credits for r in cost.increment_usage(calls, keys, unit="credits").collect()}
    assert got == {1: 15, 2: 5, 3: 0, 4: 7}


def test_adoption_of_an_account_with_only_unknown_tools(spark):
    out = cost.tool_adoption(spark.createDataFrame([Row(account_id=7, tool="bogus")])).first()
    assert (out.tools, out.n_tools, out.valid, out.status) == ("", 0, False, "disabled")


def test_budget_with_negative_balance_and_ratio_without_successes(spark):
    priced = spark.createDataFrame([Row(account_id=1, estimated_credits=3)])
    accounts = spark.createDataFrame([Row(account_id=1, monthly_budget=-50)])
    r = cost.budget_status(priced, accounts).first()
    assert (r.remaining, r.percentage, r.message) == (0, 0, "No budget set. Use setMonthlyBudget() to configure.")
    rows = [Row(tool="crawl", estimated_credits=7, http_status=500)]
    out = {r.tool: r.credits_per_success for r in cost.credits_per_success(spark.createDataFrame(rows)).collect()}
    assert out == {"crawl": None, None: None}  # no successes: no ratio


def test_url_sketches_merge_like_one(spark):
    """Sketches of parts, merged day by day, estimate what one over all does; repeats count once."""
    rows = spark.range(60_000).selectExpr(
        "id % 3 account_id", "concat('https://a.test/', id % 20011) url", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 10 as int)) ts")
    whole = cost.url_sketches(rows)
    parts = cost.add_sketches(cost.url_sketches(rows.where("account_id = 0")), cost.url_sketches(rows))
    exact = {r.account_id: r.distinct_urls for r in cost.distinct_urls(rows).collect()}
    days = [F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-10")]
    for sketches in (whole, parts):
        about = {r.account_id: r.approx_urls for r in cost.distinct_urls_between(sketches, *days).collect()}
        assert about.keys() == exact.keys() and all(abs(about[k] - n) <= 0.03 * n for k, n in exact.items())
    none = cost.distinct_urls_between(whole, *[F.lit("2023-01-01").cast("date")] * 2)
    assert none.count() == 0
