"""Queries for the URL cache, payloads and state merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.operators import cache, payload
from webledger.operators import cost as cost_ops
from webledger.plans.oracle import view
from webledger.plans.q_cost import _ROUTE_SQL, fetches
from webledger.plans.registry import query
from webledger.sources import tables
from webledger.sources.versions import VersionedTable

SPLIT = "2024-01-16 00:00:00"


def _split():
    return F.lit(SPLIT).cast("timestamp_ntz")


def _writes(v):
    """Successful fetches as cache writes."""
    return fetches(v).where(cost_ops.succeeded(F.col("http_status"))).withColumnRenamed("estimated_credits", "credits")


def cache_first_half(v):
    return cache.record_fetches(_writes(v).where(F.col("ts") < _split()))


view("cache_v1", f"""
select url, tool, format, cached_at, credits, n_writes, credits_written from (
  select url, tool, coalesce(format, 'markdown') as format, ts as cached_at, estimated_credits as credits,
    row_number() over (partition by url order by ts desc, request_id desc) as rn,
    count(*) over (partition by url) as n_writes,
    cast(sum(estimated_credits) over (partition by url) as bigint) as credits_written
  from fetches where http_status between 200 and 299 and ts < timestamp '{SPLIT}') w
where rn = 1
""")


@query("k1_cache_lookup", f"""
select p.request_id,
  case when c.url is null or p.ts > c.cached_at + interval 24 hours or c.format <> p.format then false else true end as skip,
  case when c.url is null then 'URL not cached'
       when p.ts > c.cached_at + interval 24 hours then 'Cache expired'
       when c.format <> p.format then concat('Different format requested (cached: ', c.format, ', requested: ', p.format, ')')
       else concat('Already scraped ', c.tool, ' at ', strftime(c.cached_at, '%Y-%m-%dT%H:%M:%S.%gZ'),
                   ' (', c.credits, ' credits saved)') end as cache_reason
from fetches p left join cache_v1 c on c.url = p.url
where p.ts >= timestamp '{SPLIT}'
""")
def k1_cache_lookup(v):
    probes = fetches(v).where(F.col("ts") >= _split()).select("request_id", "url", "format", "ts")
    out = cache.cache_lookup(probes, cache_first_half(v), as_of=F.col("ts"))
    return out.select("request_id", "skip", "cache_reason")


@query("k3_record_fetches", """
select url, tool, format, cached_at, credits, n_writes, credits_written from (
  select url, tool, coalesce(format, 'markdown') as format, ts as cached_at, estimated_credits as credits,
    row_number() over (partition by url order by ts desc, request_id desc) as rn,
    count(*) over (partition by url) as n_writes,
    cast(sum(estimated_credits) over (partition by url) as bigint) as credits_written
  from fetches where http_status between 200 and 299) w
where rn = 1
""")
def k3_record_fetches(v):
    return cache.record_fetches(_writes(v))


@query("k4_cache_stats", """
select count(*) as total_urls, coalesce(sum(credits), 0)::bigint as total_credits_saved,
  min(cached_at) as oldest_entry, max(cached_at) as newest_entry,
  concat('Cached ', count(*), ' URLs, saved ', coalesce(sum(credits), 0)::bigint, ' credits') as message
from cache_v1
""")
def k4_cache_stats(v):
    return cache.cache_stats(cache_first_half(v))


@query("k5_dedupe_batch", """
select r.request_id, r.batch, r.url, r.format, f.fetched_by, r.request_id = f.fetched_by as is_fetch
from (select request_id, cast(ts as date) as batch, url, format from fetches) r
join (select cast(ts as date) as batch, url, format, min(request_id) as fetched_by from fetches group by 1, 2, 3) f
  on f.batch = r.batch and f.url = r.url and f.format = r.format
""")
def k5_dedupe_batch(v):
    reqs = fetches(v).select("request_id", "ts", "url", "format")
    out = cache.dedupe_batch(reqs, F.to_date("ts"), ["url", "format"])
    return out.select("request_id", "batch", "url", "format", "fetched_by", "is_fetch")


@query("s5_merge_latest", f"""
select url, tool, format, cached_at, credits from (
  select *, row_number() over (partition by url order by cached_at desc, src desc) as rn from (
    select url, tool, format, cached_at, credits, 0 as src from cache_v1
    union all
    select url, tool, format, ts as cached_at, estimated_credits as credits, 1 as src
    from fetches where http_status between 200 and 299 and ts >= timestamp '{SPLIT}') u) x
where rn = 1
""")
def s5_merge_latest(v):
    current = cache_first_half(v).select("url", "tool", "format", "cached_at", "credits")
    updates = _writes(v).where(F.col("ts") >= _split()).select(
        "url", "tool", "format", F.col("ts").alias("cached_at"), "credits"
    )
    return payload.merge_latest(current, updates, ["url"], ["cached_at"])


_MERGED = f"""
select url, tool, format, cached_at, credits from (
  select *, row_number() over (partition by url order by cached_at desc, src desc) as rn from (
    select url, tool, format, cached_at, credits, 0 as src from cache_v1
    union all
    select url, tool, format, ts as cached_at, estimated_credits as credits, 1 as src
    from fetches where http_status between 200 and 299 and ts >= timestamp '{SPLIT}') u) x
where rn = 1
"""


@query("s5_merge_versions", f"""
select 1 as version, url, tool, format, cached_at, credits from cache_v1
union all select 2, url, tool, format, cached_at, credits from ({_MERGED}) m
""")
def s5_merge_versions(v):
    """The cache published after the first half of the log, the second half merged in, and both versions read."""
    columns = ["url", "tool", "format", "cached_at", "credits"]
    first = cache_first_half(v).select(*columns)
    table = VersionedTable(v.spark, tables.state_path(v.spark, "cache-versions"), first.schema)
    table.publish(first)
    updates = _writes(v).where(F.col("ts") >= _split()).select("url", "tool", "format", F.col("ts").alias("cached_at"), "credits")
    table.merge(updates, ["url"], ["cached_at"])
    one, two = (table.read(n).select(F.lit(n).alias("version"), *columns) for n in (1, 2))
    return one.unionByName(two)


@query("j1_parse_payloads", """
select request_id,
  case when body is null or body = '' then 'empty' when json_valid(body) then 'json' else 'text' end as payload_kind,
  case when body <> '' and not json_valid(body) then body end as raw_text,
  case when json_valid(body) then try_cast(regexp_extract(body, '.*"ok":(true|false)', 1) as boolean) end as ok
from attempts
""")
def j1_parse_payloads(v):
    parsed = payload.parse_payloads(v.attempts)
    return parsed.select(
        "request_id", "payload_kind", "raw_text",
        F.expr("try_variant_get(payload, '$.ok', 'boolean')").alias("ok"),
    )


@query("j1_payload_counts", """
select case when body is null or body = '' then 'empty' when json_valid(body) then 'json' else 'text' end as payload_kind,
  count(*) as bodies
from attempts group by 1
""")
def j1_payload_counts(v):
    return payload.payload_counts(payload.parse_payloads(v.attempts))


@query("j2_compact_params", """
select request_id, '{' || concat_ws(',',
    case when tool in ('scrape', 'crawl', 'map') then '"url":"' || url || '"' end,
    case when tool = 'scrape' then '"formats":["' || format || '"]' end,
    case when tool in ('crawl', 'search') then '"limit":' || n end,
    case when tool = 'interact' then '"ttl":' || n end,
    case when tool = 'search' and with_scrape then '"scrapeOptions":{}' end) || '}' as params_json
from (select r.*, p.url from requests r join pages p on p.page_id = r.page_id) x
""")
def j2_compact_params(v):
    pages = v.table("pages").select("page_id", "url")
    r = v.requests.join(pages, "page_id")
    tool = F.col("tool")
    fields = {
        "url": F.when(tool.isin("scrape", "crawl", "map"), F.col("url")),
        "formats": F.when(tool == "scrape", F.array("format")),
        "limit": F.when(tool.isin("crawl", "search"), F.col("n")),
        "ttl": F.when(tool == "interact", F.col("n")),
        "scrapeOptions": F.when((tool == "search") & F.col("with_scrape"),
                                F.create_map().cast("map<string,string>")),
    }
    return payload.compact_params(r, fields).select("request_id", "params_json")


_REPLAY_SQL = """
with recursive ord as (
  select request_id, url, coalesce(format, 'markdown') as format, ts, tool, estimated_credits as credits,
    row_number() over (partition by url order by ts, request_id) as rn
  from fetches),
walk as (
  select url, rn, request_id, false as hit, format as c_fmt, ts as c_ts, tool as c_tool, credits as c_credits,
    'URL not cached' as reason
  from ord where rn = 1
  union all
  select o.url, o.rn, o.request_id,
    (o.ts <= w.c_ts + interval 24 hours and o.format = w.c_fmt) as hit,
    case when o.ts <= w.c_ts + interval 24 hours and o.format = w.c_fmt then w.c_fmt else o.format end,
    case when o.ts <= w.c_ts + interval 24 hours and o.format = w.c_fmt then w.c_ts else o.ts end,
    case when o.ts <= w.c_ts + interval 24 hours and o.format = w.c_fmt then w.c_tool else o.tool end,
    case when o.ts <= w.c_ts + interval 24 hours and o.format = w.c_fmt then w.c_credits else o.credits end,
    case when o.ts > w.c_ts + interval 24 hours then 'Cache expired'
         when o.format <> w.c_fmt then concat('Different format requested (cached: ', w.c_fmt, ', requested: ', o.format, ')')
         else concat('Already scraped ', w.c_tool, ' at ', strftime(w.c_ts, '%Y-%m-%dT%H:%M:%S.%gZ'),
                     ' (', w.c_credits, ' credits saved)') end
  from walk w join ord o on o.url = w.url and o.rn = w.rn + 1)
"""


def replay_log(v):
    return fetches(v).select("request_id", "url", "format", "ts", "tool",
                             F.col("estimated_credits").alias("credits"))


@query("k2_replay_cache", _REPLAY_SQL + "select request_id, hit, reason from walk")
def k2_replay_cache(v):
    from webledger.operators.replay import replay_cache

    return replay_cache(replay_log(v))


@query("k2_replay_summary", _REPLAY_SQL + """
select count(*) filter (where hit) as hits, count(*) filter (where not hit) as misses, count(*) as requests from walk
""")
def k2_replay_summary(v):
    from webledger.operators.replay import replay_cache, replay_summary

    return replay_summary(replay_cache(replay_log(v)))


@query("c4_plan_goals_cached", f"""
select goal_id, recommended_tool, skip, cache_reason,
  case when skip then 'SKIP: ' when not skip then 'FETCH: ' end || cache_reason as cache_message
from (
select g.goal_id, {_ROUTE_SQL} as recommended_tool,
  case when p.url is null then null
       when c.url is null or timestamp '{SPLIT}' > c.cached_at + interval 24 hours or c.format <> 'markdown' then false
       else true end as skip,
  case when p.url is null then null
       when c.url is null then 'URL not cached'
       when timestamp '{SPLIT}' > c.cached_at + interval 24 hours then 'Cache expired'
       when c.format <> 'markdown' then concat('Different format requested (cached: ', c.format, ', requested: markdown)')
       else concat('Already scraped ', c.tool, ' at ', strftime(c.cached_at, '%Y-%m-%dT%H:%M:%S.%gZ'),
                   ' (', c.credits, ' credits saved)') end as cache_reason
from intents g left join pages p on p.page_id = g.goal_id and g.source = 'template'
left join cache_v1 c on c.url = p.url) x
""")
def c4_plan_goals_cached(v):
    """C4 with the cache verdict: each templated goal's URL (the captured page
    with the goal's id) is checked against the cache as of the split instant;
    free-text goals carry no URL."""
    pages = v.table("pages").select(F.col("page_id").alias("goal_id"), "url")
    templated = v.intents.where(F.col("source") == "template")
    probes = templated.join(pages, "goal_id").select("goal_id", "url", F.lit("markdown").alias("format"))
    status = cache.cache_lookup(probes, cache_first_half(v), as_of=_split()).select("goal_id", "skip", "cache_reason")
    return cost_ops.plan_goals(v.intents, status).select(
        "goal_id", "recommended_tool", "skip", "cache_reason", "cache_message")


@query("c7_set_budget", """
select account_id, case when plan = 'BUILDING' then greatest(monthly_budget, 0) + 500 else monthly_budget end
  as monthly_budget
from accounts
""")
def c7_set_budget(v):
    acc = v.accounts
    updates = acc.where(F.col("plan") == "BUILDING").select(
        "account_id", (F.greatest(F.col("monthly_budget"), F.lit(0)) + 500).alias("monthly_budget"))
    return cost_ops.set_budget(acc, updates).select("account_id", "monthly_budget")


@query("s1_read_captures", "select page_id, url, length(html) as html_chars from pages")
def s1_read_captures(v):
    from webledger.sources.tables import read_captures

    pages = read_captures(v.spark, f"{v.sf_dir.rstrip('/')}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("html_chars"))


def _enc_sql(c: str) -> str:
    return (f"replace(replace(replace(replace(replace(replace(url_encode({c}), '%21', '!'), '%27', ''''), "
            f"'%28', '('), '%29', ')'), '%7E', '~'), '%2A', '*')")


@query("j3_request_paths", f"""
select call_id, case when tool in ('scrape', 'crawl', 'map', 'search', 'interact') then '/' || tool end as path
from (select 'r' || request_id as call_id, tool from requests) r
union all
select 'j' || job_id, '/crawl/' || {_enc_sql("cast(job_id as varchar)")} from jobs
union all
select 'm' || monitor_id, '/monitor/' || {_enc_sql('name')} || '/checks' ||
  case when concat_ws('&', case when monitor_id % 4 <> 0 then 'limit=' || (monitor_id % 4 * 25) end,
                           case when monitor_id % 3 <> 0 then 'offset=' || (monitor_id % 3) end) <> ''
       then '?' || concat_ws('&', case when monitor_id % 4 <> 0 then 'limit=' || (monitor_id % 4 * 25) end,
                                  case when monitor_id % 3 <> 0 then 'offset=' || (monitor_id % 3) end)
       else '' end
from monitors
union all
select 'a' || account_id, '/monitor' ||
  case when concat_ws('&', case when account_id % 101 <> 0 then 'limit=' || (account_id % 101) end,
                           case when account_id % 7 <> 0 then 'offset=' || (account_id % 7) end) <> ''
       then '?' || concat_ws('&', case when account_id % 101 <> 0 then 'limit=' || (account_id % 101) end,
                                  case when account_id % 7 <> 0 then 'offset=' || (account_id % 7) end)
       else '' end
from accounts
""")
def j3_request_paths(v):
    """The API path of every call the tables describe: each request, a status
    call per crawl job, a checks page per monitor, a monitor list per account."""
    none = F.lit(None).cast("bigint")
    calls = (
        v.requests.select(F.concat(F.lit("r"), F.col("request_id")).alias("call_id"), "tool",
                          F.lit(None).cast("string").alias("id"), none.alias("limit"), none.alias("offset"))
        .unionByName(v.jobs.select(F.concat(F.lit("j"), F.col("job_id")).alias("call_id"),
                                   F.lit("crawl_status").alias("tool"), F.col("job_id").cast("string").alias("id"),
                                   none.alias("limit"), none.alias("offset")))
        .unionByName(v.monitors.select(F.concat(F.lit("m"), F.col("monitor_id")).alias("call_id"),
                                       F.lit("monitor_checks").alias("tool"), F.col("name").alias("id"),
                                       (F.col("monitor_id") % 4 * 25).alias("limit"),
                                       (F.col("monitor_id") % 3).alias("offset")))
        .unionByName(v.accounts.select(F.concat(F.lit("a"), F.col("account_id")).alias("call_id"),
                                       F.lit("monitor_list").alias("tool"), F.lit(None).cast("string").alias("id"),
                                       (F.col("account_id") % 101).alias("limit"),
                                       (F.col("account_id") % 7).alias("offset")))
    )
    return payload.request_paths(calls).select("call_id", "path")


@query("s3_usage_ledger_roundtrip", """
select sha256(key_text) as key_hash, used_credits, remaining_credits, monthly_quota as plan_credits,
  strptime(last_checked, '%Y-%m-%dT%H:%M:%S.%gZ') as last_checked
from keys where last_checked <> ''
""")
def s3_usage_ledger_roundtrip(v):
    """The usage ledger written as JSON Lines to the shared folder and read back."""
    from webledger.plans.q_pool import key_usage
    from webledger.sources import tables

    path = tables.write_state(key_usage(v), tables.state_path(v.spark, "usage"))
    return tables.read_usage_lines(v.spark, path)


@query("s4_url_cache_roundtrip", """
select url, tool, format, cached_at, credits from cache_v1
""")
def s4_url_cache_roundtrip(v):
    """The URL cache written as JSON Lines (ISO timestamps) and read back."""
    from webledger.sources import tables

    entries = cache_first_half(v).select(
        "url", "tool", "format", F.date_format("cached_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "credits",
    )
    path = tables.write_state(entries, tables.state_path(v.spark, "cache"))
    return tables.read_cache_lines(v.spark, path)
