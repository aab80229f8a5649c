"""Queries over the request log: pricing, routing, budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.functions.urls import site_of
from webledger.operators import cost
from webledger.plans.oracle import view
from webledger.plans.registry import query
from webledger.session import stored

view("fetches", """
select r.request_id, r.ts, r.account_id, r.tool, r.format, r.key_id, r.http_status, p.url, r.estimated_credits
from priced r join pages p on p.page_id = r.page_id
""")


def fetches(v):
    """Priced requests with the URL of the captured page they fetch."""
    pages = v.table("pages").select("page_id", "url")
    return cost.priced_requests(v.requests).join(pages, "page_id")


@query("c1_estimate_cost", """
select request_id, tool, estimated_credits,
  case tool
    when 'scrape' then case format when 'json' then '1 base + +4 JSON'
                                   when 'screenshot' then '1 base + +1 screenshot' else '1 credit(s)' end
    when 'crawl' then concat(n, ' pages x 1 credit(s) = ', n, ' credits')
    when 'search' then case when with_scrape
         then concat(cast(ceil(n / 10.0) as bigint) * 2, ' search + ', n, ' scrape = ', estimated_credits, ' credits')
         else concat(estimated_credits, ' credits (no scraping)') end
    when 'map' then '1 credit for URL discovery'
    when 'interact' then concat(cast(ceil(n / 60.0) as bigint), ' min x 2 credits/min = ', estimated_credits, ' credits')
    else concat(estimated_credits, ' credit(s)') end as reason
from priced
""")
def c1_estimate_cost(v):
    return cost.priced_requests(v.requests).select("request_id", "tool", "estimated_credits", "reason")


@query("c2_estimate_alternative", """
select request_id, cheaper_alternative, alternative_savings,
  case when cheaper_alternative is not null
       then concat('Consider using ', cheaper_alternative, ' instead to save ', alternative_savings, ' credits.')
       else 'This is already the cheapest option.' end as tip
from (
  select request_id,
    case tool when 'scrape' then 'map + scrape' when 'crawl' then 'map + selective scrape'
              when 'search' then case when with_scrape then 'search without scrapeOptions' end
              when 'interact' then 'scrape with actions' end as cheaper_alternative,
    cast(case tool when 'scrape' then greatest(0, estimated_credits - 2)
              when 'crawl' then greatest(0, n - cast(ceil(cast(n as double) * cast(0.2 as double)) as bigint) - 1)
              when 'search' then case when with_scrape then n else 0 end
              when 'interact' then greatest(0, estimated_credits - 1) end as bigint) as alternative_savings
  from priced) x
""")
def c2_estimate_alternative(v):
    return cost.priced_requests(v.requests).select(
        "request_id", "cheaper_alternative", "alternative_savings", "tip"
    )


_REASON_SQL = """
case recommended_tool
  when 'map' then 'Map discovers all URLs for 1 credit. Scrape only what you need after.'
  when 'search' then 'Search discovers relevant pages. Scrape only top results after.'
  when 'monitor_create' then 'Monitor checks automatically and only charges for actual changes.'
  when 'parse' then 'Parse handles local files directly.'
  else case when rule5 = 1 then 'Scrape is the cheapest for single URLs. Markdown format (no JSON surcharge).'
            else 'Default: scrape with markdown format (1 credit, no surcharges).' end end
"""
_RULE5_SQL = """
case when contains(lower(goal), 'scrape') or contains(lower(goal), 'this url') or contains(lower(goal), 'this page')
          or contains(lower(goal), 'extract from') then 1 else 0 end
"""
_ROUTE_SQL = """
case
  when contains(lower(goal), 'all pages') or contains(lower(goal), 'every page') or contains(lower(goal), 'site map')
       or contains(lower(goal), 'list all urls') then 'map'
  when contains(lower(goal), 'search') or contains(lower(goal), 'find') or contains(lower(goal), 'discover')
       or contains(lower(goal), 'look for') then 'search'
  when contains(lower(goal), 'monitor') or contains(lower(goal), 'watch') or contains(lower(goal), 'notify')
       or contains(lower(goal), 'alert') or contains(lower(goal), 'track changes') then 'monitor_create'
  when contains(lower(goal), 'pdf') or contains(lower(goal), 'docx') or contains(lower(goal), 'xlsx')
       or contains(lower(goal), 'local file') or contains(lower(goal), 'upload') then 'parse'
  else 'scrape' end
"""


@query("c3_route_goals", f"""
select goal_id, goal, recommended_tool, {_REASON_SQL} as route_reason
from (select goal_id, goal, {_ROUTE_SQL} as recommended_tool, {_RULE5_SQL} as rule5 from intents) g
""")
def c3_route_goals(v):
    return cost.route_goals(v.intents).select("goal_id", "goal", "recommended_tool", "route_reason")


@query("c4_plan_goals", f"""
select goal_id, recommended_tool, {_REASON_SQL} as route_reason,
  case recommended_tool when 'search' then 2 else 1 end::bigint as estimated_credits,
  case recommended_tool when 'scrape' then '1 credit(s)' when 'search' then '2 credits (no scraping)'
       when 'map' then '1 credit for URL discovery' when 'parse' then '1 credit per page' else '1 credit(s)' end as cost_breakdown,
  case recommended_tool when 'scrape' then 'map + scrape' end as cheaper_alternative,
  case recommended_tool when 'scrape' then 0 when 'search' then 0 end::bigint as alternative_savings,
  case recommended_tool when 'scrape' then 'Consider using map + scrape instead to save 0 credits.'
       else 'This is already the cheapest option.' end as tip
from (select goal_id, {_ROUTE_SQL} as recommended_tool, {_RULE5_SQL} as rule5 from intents) g
""")
def c4_plan_goals(v):
    return cost.plan_goals(v.intents).select(
        "goal_id",
        "recommended_tool",
        "route_reason",
        "estimated_credits",
        F.col("reason").alias("cost_breakdown"),
        "cheaper_alternative",
        "alternative_savings",
        "tip",
    )


@query("c5_spend_rollup", """
select account_id, tool, day, cast(sum(estimated_credits) as bigint) as credits, count(*) as calls,
  grouping(account_id, tool, day) as gid
from (select account_id, tool, cast(ts as date) as day, estimated_credits from priced) p
group by rollup(account_id, tool, day)
""")
def c5_spend_rollup(v):
    priced = cost.priced_requests(v.requests).withColumn("day", F.to_date("ts"))
    return cost.spend_cube(priced, ["account_id", "tool", "day"], "rollup")


@query("c5_spend_cube", """
select tool, format, cast(sum(estimated_credits) as bigint) as credits, count(*) as calls,
  grouping(tool, format) as gid
from priced group by cube(tool, format)
""")
def c5_spend_cube(v):
    return cost.spend_cube(cost.priced_requests(v.requests), ["tool", "format"], "cube")


@query("c6_budget_status", """
select a.account_id, coalesce(u.used, 0)::bigint as total_used, a.monthly_budget,
  greatest(0, a.monthly_budget - coalesce(u.used, 0))::bigint as remaining,
  (case when a.monthly_budget > 0 then floor(coalesce(u.used, 0) / a.monthly_budget * 100 + 0.5) else 0 end)::bigint as percentage,
  case when a.monthly_budget > 0
       then concat('Used ', coalesce(u.used, 0)::bigint, '/', a.monthly_budget, ' credits (',
                   (floor(coalesce(u.used, 0) / a.monthly_budget * 100 + 0.5))::bigint, '%)')
       else 'No budget set. Use setMonthlyBudget() to configure.' end as message
from accounts a left join (select account_id, sum(estimated_credits) as used from priced group by 1) u
  on u.account_id = a.account_id
""")
def c6_budget_status(v):
    return cost.budget_status(cost.priced_requests(v.requests), v.accounts)


@query("c7_reset_month", """
select account_id, cast(date_trunc('month', ts) as date) as month,
  cast(sum(estimated_credits) as bigint) as used_in_month, count(distinct url) as urls_cached
from fetches group by 1, 2
""")
def c7_reset_month(v):
    return cost.reset_month(fetches(v), F.col("url"))


@query("c7_set_budget_updates", """
select coalesce(a.account_id, u.account_id) as account_id, coalesce(u.b, a.monthly_budget) as monthly_budget
from accounts a full join (
  select account_id, arg_max(b, t) as b from (
    select o_custkey + 100 as account_id, cast(floor(o_totalprice) as bigint) as b,
           o_orderdate::varchar || lpad(cast(floor(o_totalprice) as bigint)::varchar, 20, '0') as t from orders) x
  group by 1) u on u.account_id = a.account_id
""")
def c7_set_budget_updates(v):
    """Budgets set from the order log: several updates per account, some of accounts not in the table."""
    updates = v.table("orders").select(
        (F.col("o_custkey") + 100).alias("account_id"), F.floor("o_totalprice").cast("bigint").alias("monthly_budget"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return cost.set_budget(v.accounts, updates).select("account_id", "monthly_budget")


@query("c8_compare_strategies", """
select site, count(*) as n_pages, count(*) filter (where contains(url, '/en/')) as wanted,
  count(*) as crawl_credits, count(*) filter (where contains(url, '/en/')) + 1 as map_scrape_credits,
  cast(1 as bigint) as map_only_credits,
  case when count(*) filter (where contains(url, '/en/')) + 1 < count(*) then 'map + scrape' else 'crawl' end as winner,
  abs(count(*) - (count(*) filter (where contains(url, '/en/')) + 1)) as saving
from (select url, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '^(www|m|blog)\\.', '') as site
      from pages) p
group by site
""")
def c8_compare_strategies(v):
    return cost.compare_strategies(v.table("pages"), site_of(F.col("url")), F.col("url").contains("/en/"))


@query("c9_compare_interact", """
select request_id, estimated_credits as interact_credits,
  case when ceil(n / 60.0) >= 5 then null else 1 end::bigint as scrape_credits,
  case when ceil(n / 60.0) >= 5 then 'interact' else 'scrape' end as winner,
  case when ceil(n / 60.0) >= 5 then null
       else floor((estimated_credits - 1) / estimated_credits * 100 + 0.5) end::bigint as saving_pct
from priced where tool = 'interact'
""")
def c9_compare_interact(v):
    priced = cost.priced_requests(v.requests)
    # Sessions of five minutes or more stand for login or multi-step flows
    # (the worked examples: 5- and 6-minute flows have no scrape option).
    needs_login = F.ceil(F.col("n") / 60.0) >= 5
    return cost.compare_interact(priced, needs_login)


@query("c11_credits_per_success", """
select tool, credits, successes,
  case when successes > 0 then cast((credits * 100) // successes as double) / 100.0 end as credits_per_success
from (select tool, cast(sum(estimated_credits) as bigint) as credits,
             count(*) filter (where http_status between 200 and 299) as successes
      from priced group by rollup(tool)) t
""")
def c11_credits_per_success(v):
    return cost.credits_per_success(cost.priced_requests(v.requests))


_INCREMENT_SQL = """
select k.key_id, coalesce(k.used_credits, 0)::bigint as used_credits, coalesce(a.added, 0)::bigint as added,
  (coalesce(k.used_credits, 0) + coalesce(a.added, 0))::bigint as new_used_credits, a.last_try
from (select key_id, case when key_id % 6 <> 5 then used_credits end as used_credits from keys) k
left join (select t.key_id, sum(case when t.http_status between 200 and 299 then {amount} end) as added, max(t.ts) as last_try
           from attempts t join priced p on p.request_id = t.request_id group by 1) a
  on a.key_id = k.key_id
where k.used_credits is not null or a.last_try is not null
"""


def _calls(v):
    """Every try with the credits of its request."""
    credits = cost.priced_requests(v.requests).select("request_id", "estimated_credits")
    return v.attempts.join(credits, "request_id")


def _ledger(v):
    """The keys; every sixth has no usage row yet."""
    return v.keys.withColumn("used_credits", F.when(F.col("key_id") % 6 != 5, F.col("used_credits")))


@query("c12_increment_usage", _INCREMENT_SQL.format(amount="1"))
def c12_increment_usage(v):
    return cost.increment_usage(_calls(v), _ledger(v), "request")


@query("c12_increment_usage_credits", _INCREMENT_SQL.format(amount="p.estimated_credits"))
def c12_increment_usage_credits(v):
    return cost.increment_usage(_calls(v), _ledger(v), "credits")


@query("c13_distinct_urls", "select account_id, count(distinct url) as distinct_urls from fetches group by 1")
def c13_distinct_urls(v):
    return cost.distinct_urls(fetches(v))


@query("c13_distinct_urls_approx")
def c13_distinct_urls_approx(v):
    return cost.distinct_urls(fetches(v), approximate=True)


@query("c13_distinct_urls_sketches", """
select account_id, count(distinct url) as distinct_urls, true as within_3_percent from fetches
where cast(ts as date) between date '2024-01-05' and date '2024-01-24' group by 1
""")
def c13_distinct_urls_sketches(v):
    """A range of days from stored sketches, kept up with the log in two steps, against the exact counts."""
    f = fetches(v).select("account_id", "ts", "url")
    early = F.col("ts") < F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")  # the day of the cut has sketches of both steps
    kept = stored(cost.url_sketches(f.where(early)), "url-sketches")
    kept = stored(cost.add_sketches(kept, cost.url_sketches(f.where(~early))), "url-sketches")
    first, last = (F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-24"))
    about = cost.distinct_urls_between(kept, first, last)
    exact = cost.distinct_urls(f.where(F.col("ts").cast("date").between(first, last)))
    close = F.abs(F.col("approx_urls") - F.col("distinct_urls")) <= 0.03 * F.col("distinct_urls")
    return exact.join(about, "account_id", "left").select("account_id", "distinct_urls", F.coalesce(close, F.lit(False)).alias("within_3_percent"))


_CANON = "['scrape','crawl','crawl_status','map','search','parse','interact','monitor_create','monitor_list','monitor_checks','optimize']"


@query("c14_tool_adoption", f"""
select account_id, array_to_string(ordered, ',') as tools, len(ordered) as n_tools, account_id % 7 <> 3 as valid,
  case when len(ordered) = 11 then 'enabled' when len(ordered) = 0 then 'disabled' else 'partial' end as status
from (select account_id, list_filter({_CANON}, lambda t: list_contains(s, t)) as ordered
      from (select account_id, list(distinct tool) as s from requests group by 1) x) y
""")
def c14_tool_adoption(v):
    return cost.tool_adoption(_selections(v))


def _selections(v):
    """Tools by account; some accounts also name a tool that doesn't exist."""
    named = v.requests.select("account_id", "tool")
    return named.unionByName(named.where("account_id % 7 = 3").withColumn("tool", F.concat("tool", F.lit("_old"))))


@query("c14_adoption_counts", f"""
select status, count(*) as accounts from (
  select case when len(ordered) = 11 then 'enabled' when len(ordered) = 0 then 'disabled' else 'partial' end as status
  from (select list_filter({_CANON}, lambda t: list_contains(s, t)) as ordered
        from (select account_id, list(distinct tool) as s from requests group by 1) x) y) z
group by 1
""")
def c14_adoption_counts(v):
    return cost.adoption_counts(cost.tool_adoption(v.requests))
