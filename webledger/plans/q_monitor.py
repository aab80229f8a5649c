"""Queries for change monitoring and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.operators import monitor as M
from webledger.operators import search as S
from webledger.operators import sets as U
from webledger.plans.oracle import VIEWS, view
from webledger.plans.q_cache import SPLIT
from webledger.plans.q_pages import md_sql
from webledger.plans.registry import query
from webledger.session import stored
from webledger.sources.tables import state_path
from webledger.streaming.jobs import read_request_stream, write_alerts

# Views of monitor targets, derived by rule from customers and pages ---------

view("monitor_units", """
select m.monitor_id, 'scrape' as target_type, p.url as unit, true as valid
from (select monitor_id, unnest(range(0, monitor_id % 3 + 1)) as i from monitors where target_type = 'scrape') m
join pages p on p.page_id = (m.monitor_id * 7 + m.i) % (select count(*) from pages)
union all
select m.monitor_id, 'crawl', regexp_extract(p.url, '^([a-z][a-z0-9+.-]*://[^/?#]+)', 1) || '/', true
from monitors m join pages p on p.page_id = (m.monitor_id * 7) % (select count(*) from pages)
where m.target_type = 'crawl'
union all
select monitor_id, 'search', unnest([lower(goal_topic), lower(goal_topic) || ' news']), goal_topic is not null
from monitors where target_type = 'search'
""")

view("capture_diff", """
select coalesce(a.url, b.url) as url,
  case when a.url is null then 'new' when b.url is null then 'removed'
       when sha256(a.html) <> sha256(b.html) then 'changed' else 'same' end as status
from capture_v1 a full outer join capture_v2 b on a.url = b.url
""")

view("line_diff", f"""
with ch as (select a.url, {md_sql('a.html')} as old_md, {md_sql('b.html')} as new_md
            from capture_v1 a join capture_v2 b on a.url = b.url where sha256(a.html) <> sha256(b.html)),
nl as (select distinct url, unnest(string_split(new_md, chr(10))) as line from ch),
ol as (select distinct url, unnest(string_split(old_md, chr(10))) as line from ch)
select url, 'added' as kind, line from (select * from nl except select * from ol) x where line <> ''
union all
select url, 'removed', line from (select * from ol except select * from nl) y where line <> ''
""")


def monitor_targets(v):
    """Each monitor's targets in the reference's shape: an array of
    {type, urls, url, queries} structs plus the goal."""
    m = v.monitors
    pages = v.table("pages").select("page_id", "url")
    n_pages = pages.count()
    scrape = (
        m.where(F.col("target_type") == "scrape")
        .select("monitor_id", F.explode(F.sequence(F.lit(0), (F.col("monitor_id") % 3).cast("int"))).alias("i"))
        .withColumn("page_id", (F.col("monitor_id") * 7 + F.col("i")) % n_pages)
        .join(pages, "page_id")
        .groupBy("monitor_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "url"))), lambda s: s["url"]).alias("urls"))
    )
    crawl = (
        m.where(F.col("target_type") == "crawl")
        .withColumn("page_id", (F.col("monitor_id") * 7) % n_pages)
        .join(pages, "page_id")
        .select("monitor_id", M.crawl_root(F.col("url")).alias("root"))
    )
    t = m.join(scrape, "monitor_id", "left").join(crawl, "monitor_id", "left")
    topic = F.lower("goal_topic")
    target = F.struct(
        F.col("target_type").alias("type"),
        F.col("urls"),
        F.col("root").alias("url"),
        F.when(F.col("target_type") == "search", F.array(topic, F.concat(topic, F.lit(" news")))).alias("queries"),
    )
    return t.select("monitor_id", F.col("goal_topic").alias("goal"), F.array(target).alias("targets"))


def monitor_units(v):
    return M.expand_targets(monitor_targets(v))


@query("m1_diff_captures", "select url, status from capture_diff")
def m1_diff_captures(v):
    return M.diff_captures(v.capture_v1, v.capture_v2).select("url", "status")


@query("m2_diff_lines", "select url, kind, line from line_diff")
def m2_diff_lines(v):
    return M.diff_lines(v.capture_v1, v.capture_v2)


@query("m3_relevant_changes", r"""
with c as (
  select distinct url, unnest(list_distinct(list_filter(string_split_regex(lower(line), '[^\p{L}0-9]+'),
         lambda t: t <> ''))) as term from line_diff where kind = 'added'),
g as (
  select distinct goal_id, unnest(list_distinct(list_filter(string_split_regex(lower(goal), '[^\p{L}0-9]+'),
         lambda t: t <> ''))) as term from intents),
rare as (
  select term, ln((select count(distinct url) from c) / count(*)) as weight from c group by 1
  having count(*) <= greatest(2.0, (select count(distinct url) from c) * 0.02)),
s as (
  select c.url, g.goal_id, round(sum(r.weight), 6) as score
  from c join g on g.term = c.term join rare r on r.term = c.term group by 1, 2)
select url, goal_id, score, place from (
  select *, row_number() over (partition by url order by score desc, goal_id) as place from s) x
where place <= 3
""")
def m3_relevant_changes(v):
    return M.relevant_changes(M.diff_lines(v.capture_v1, v.capture_v2), v.intents)


@query("m4_expand_targets", "select monitor_id, target_type, unit, valid from monitor_units")
def m4_expand_targets(v):
    return monitor_units(v)


@query("m4_expand_targets_invalid", """
with t as (
  select monitor_id, monitor_id % 6 as k, lower(goal_topic) as topic, 'https://' || name as u from monitors)
select monitor_id, target_type, unit, valid from (
  select monitor_id, 'search' as target_type, topic as unit, true as valid from t where k = 0
  union all select monitor_id, 'search', topic, false from t where k = 1
  union all select monitor_id, null, null, false from t where k = 2
  union all select monitor_id, 'scrape', null, false from t where k = 3
  union all select monitor_id, 'crawl', u, false from t, range(51) where k = 4
  union all select monitor_id, 'other', null, false from t where k = 5) x
""")
def m4_expand_targets_invalid(v):
    """Monitors without a goal, without targets, with a target without URLs, with too many, of unknown type."""
    k = F.col("monitor_id") % 6
    none = F.lit(None).cast("array<string>")

    def target(kind, urls=none, url=F.lit(None).cast("string"), queries=none):
        return F.struct(F.lit(kind).alias("type"), urls.alias("urls"), url.alias("url"), queries.alias("queries"))

    topic = F.lower("goal_topic")
    search = F.array(target("search", queries=F.array(topic)))
    targets = (
        F.when(k < 2, search)
        .when(k == 2, F.array().cast("array<struct<type:string,urls:array<string>,url:string,queries:array<string>>>"))
        .when(k == 3, F.array(target("scrape", urls=F.array().cast("array<string>"))))
        .when(k == 4, F.array_repeat(target("crawl", url=F.concat(F.lit("https://"), F.col("name"))), 51))
        .otherwise(F.array(target("other")))
    )
    goal = F.when(k != 1, F.col("goal_topic"))
    return M.expand_targets(v.monitors.select("monitor_id", goal.alias("goal"), targets.alias("targets")))


@query("m5_schedule_slots", """
select monitor_id, slot_ts from (
  select monitor_id, unnest(generate_series(timestamp '1995-03-01 00:00:00', timestamp '1995-03-02 00:00:00',
                                            to_minutes(greatest(every_minutes, 5)))) as slot_ts from monitors) s
where slot_ts < timestamp '1995-03-02 00:00:00'
""")
def m5_schedule_slots(v):
    return M.schedule_slots(v.monitors, "1995-03-01 00:00:00", "1995-03-02 00:00:00")


@query("n7_missed_checks", """
with s as (
  select monitor_id, slot_ts from (
    select monitor_id, unnest(generate_series(timestamp '1995-03-01 00:00:00', timestamp '1995-03-08 00:00:00',
                                              to_minutes(greatest(every_minutes, 5)))) as slot_ts from monitors) x
  where slot_ts < timestamp '1995-03-08 00:00:00')
select monitor_id, count(*) as n_slots,
  count(*) filter (where not exists (select 1 from checks c where c.monitor_id = s.monitor_id
                   and abs(epoch_us(c.checked_at) - epoch_us(s.slot_ts)) <= 1800000000)) as n_missed
from s group by 1
""")
def n7_missed_checks(v):
    slots = M.schedule_slots(v.monitors, "1995-03-01 00:00:00", "1995-03-08 00:00:00")
    missed = M.missed_checks(slots, v.checks, 30)
    total = slots.groupBy("monitor_id").agg(F.count(F.lit(1)).alias("n_slots"))
    miss = missed.groupBy("monitor_id").agg(F.count(F.lit(1)).alias("n_missed"))
    return total.join(miss, "monitor_id", "left").select(
        "monitor_id", "n_slots", F.coalesce("n_missed", F.lit(0)).alias("n_missed")
    )


@query("m6_list_monitors", """
select m.monitor_id, m.name, m.target_type, coalesce(s.n_checks, 0) as n_checks, s.last_checked_at, s.last_outcome
from monitors m left join (
  select monitor_id, count(*) as n_checks, max(checked_at) as last_checked_at,
    arg_max(outcome, checked_at::varchar || lpad(check_id::varchar, 20, '0')) as last_outcome
  from checks group by 1) s on s.monitor_id = m.monitor_id
order by m.monitor_id limit 25 offset 25
""")
def m6_list_monitors(v):
    out = M.list_monitors(v.monitors, v.checks, limit=25, offset=25)
    return out.select("monitor_id", "name", "target_type", "n_checks", "last_checked_at", "last_outcome")


@query("m7_monitor_checks", """
select check_id, monitor_id, checked_at, outcome from (
  select *, row_number() over (partition by monitor_id order by checked_at desc, check_id desc) as rn
  from checks where monitor_id in (select monitor_id from monitors where target_type = 'search')) x
where rn > 1 and rn <= 4
""")
def m7_monitor_checks(v):
    ids = v.monitors.where(F.col("target_type") == "search").select("monitor_id")
    return M.monitor_checks(v.checks, ids, limit=3, offset=1).select("check_id", "monitor_id", "checked_at", "outcome")


def _notify(v):
    m = v.monitors
    rec = F.transform(
        F.sequence(F.lit(1), (F.col("monitor_id") % 30 + 1).cast("int")),
        lambda i: F.concat(F.lit("r"), i.cast("string"), F.lit("@"), F.lower("goal_topic"), F.lit(".example")),
    )
    return m.select("monitor_id", (F.col("monitor_id") % 2 == 0).alias("enabled"), rec.alias("recipients"))


@query("m8_fan_out_alerts", """
select u.monitor_id, c.url, c.status, r.recipient, u.monitor_id % 30 + 1 <= 25 as valid
from capture_diff c
join monitor_units u on u.unit = c.url and u.target_type = 'scrape'
join (select monitor_id, unnest(list_transform(range(1, cast(monitor_id % 30 + 2 as bigint)),
        lambda i: 'r' || i || '@' || lower(goal_topic) || '.example')) as recipient
      from monitors where monitor_id % 2 = 0) r on r.monitor_id = u.monitor_id
where c.status in ('changed', 'new')
""")
def m8_fan_out_alerts(v):
    changes = M.diff_captures(v.capture_v1, v.capture_v2).where(F.col("status").isin("changed", "new"))
    units = monitor_units(v).where(F.col("target_type") == "scrape")
    return M.fan_out_alerts(changes, units, _notify(v)).select("monitor_id", "url", "status", "recipient", "valid")


@query("m8_fan_out_diffs", """
select u.monitor_id, c.url, r.recipient, u.monitor_id % 30 + 1 <= 25 as valid,
  case when u.monitor_id % 4 = 0 then sha256(d.lines) end as diff_sha
from capture_diff c
join monitor_units u on u.unit = c.url and u.target_type = 'scrape'
join (select monitor_id, unnest(list_transform(range(1, cast(monitor_id % 30 + 2 as bigint)),
        lambda i: 'r' || i || '@' || lower(goal_topic) || '.example')) as recipient
      from monitors where monitor_id % 2 = 0) r on r.monitor_id = u.monitor_id
left join (select url, array_to_string(list_sort(list(case kind when 'added' then '+' else '-' end || line)), chr(10)) as lines
           from line_diff group by 1) d on d.url = c.url
where c.status = 'changed'
""")
def m8_fan_out_diffs(v):
    """Alerts with the changed lines for the monitors that ask for them."""
    changes = M.diff_captures(v.capture_v1, v.capture_v2).where(F.col("status") == "changed")
    units = monitor_units(v).where(F.col("target_type") == "scrape")
    notify = _notify(v).withColumn("include_diffs", F.col("monitor_id") % 4 == 0)
    out = M.fan_out_alerts(changes, units, notify, M.diff_lines(v.capture_v1, v.capture_v2))
    return out.select("monitor_id", "url", "recipient", "valid", F.sha2("diff", 256).alias("diff_sha"))


view("corpus_grown", """
select doc_id, text from documents union all select 1000000000000 + item_id, text from benchmark
""")
view("bm25_grown", VIEWS["bm25"].replace("from documents", "from corpus_grown"))


@query("m9_search_changes", """
select query_id, doc_id, 'entered' as change from (
  select query_id, doc_id from bm25_grown where rank <= 10 except select query_id, doc_id from bm25 where rank <= 10) a
union all
select query_id, doc_id, 'left' from (
  select query_id, doc_id from bm25 where rank <= 10 except select query_id, doc_id from bm25_grown where rank <= 10) b
""")
def m9_search_changes(v):
    """Both searches by one pass over the texts: the documents are those of the run before, the items came since."""
    grown = v.table("documents").select("doc_id", "text", F.lit(True).alias("before")).unionByName(
        v.table("benchmark").select((F.lit(1_000_000_000_000) + F.col("item_id")).alias("doc_id"), "text", F.lit(False).alias("before"))
    )
    runs = stored(S.search_versions(grown, {"before": F.col("before"), "now": F.lit(True)}, v.search_queries, limit=10), "runs")
    prev, curr = (runs.where(F.col("version") == r) for r in ("before", "now"))
    return M.search_changes(prev, curr)


@query("f5_filter_retention", """
select c.check_id, c.monitor_id from checks c left join monitors m on m.monitor_id = c.monitor_id
where c.checked_at >= timestamp '2001-08-01 00:00:00' - to_days(coalesce(m.retention_days, 30))
""")
def f5_filter_retention(v):
    as_of = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    return M.filter_retention(v.checks, v.monitors, as_of).select("check_id", "monitor_id")


def _subscriptions(v):
    k = F.col("monitor_id") % 3
    ev = F.when(k == 0, F.array(F.lit("monitor.page"), F.lit("monitor.check.completed"))).when(
        k == 1, F.array(F.lit("monitor.page"))
    ).otherwise(F.array(F.lit("monitor.check.completed")))
    return v.monitors.select("monitor_id", ev.alias("events"))


_ALERTS_SQL = """
select monitor_id, event, ref from (
  select monitor_id, 'monitor.check.completed' as event, cast(check_id as varchar) as ref from checks
  union all
  select u.monitor_id, 'monitor.page', c.url from capture_diff c
  join monitor_units u on u.unit = c.url and u.target_type = 'scrape' where c.status in ('changed', 'new')) e
where (monitor_id % 3 = 0) or (monitor_id % 3 = 1 and event = 'monitor.page')
   or (monitor_id % 3 = 2 and event = 'monitor.check.completed')
"""


@query("s7_alert_events", _ALERTS_SQL)
def s7_alert_events(v):
    changes = M.diff_captures(v.capture_v1, v.capture_v2).where(F.col("status").isin("changed", "new"))
    units = monitor_units(v).where(F.col("target_type") == "scrape").select("monitor_id", F.col("unit").alias("url"))
    return M.alert_events(v.checks, changes.join(units, "url"), _subscriptions(v))


@query("s7_alert_stream", _ALERTS_SQL)
def s7_alert_stream(v):
    """The same events as a stream into the alert table, which is then read."""
    changes = M.diff_captures(v.capture_v1, v.capture_v2).where(F.col("status").isin("changed", "new"))
    units = monitor_units(v).where(F.col("target_type") == "scrape").select("monitor_id", F.col("unit").alias("url"))
    completed, pages = M.alert_sources(v.checks, changes.join(units, "url"))
    path = state_path(v.spark, "alerts")
    events = completed.unionByName(pages)
    events.write.parquet(f"{path}/in")
    stream = read_request_stream(v.spark, f"{path}/in", events.schema, max_files_per_trigger=4)
    q = write_alerts(stream, _subscriptions(v), f"{path}/out", f"{path}/checkpoint")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return v.spark.read.schema(events.schema).parquet(f"{path}/out").select("monitor_id", "event", "ref")


# Set operations --------------------------------------------------------------

_CANON = ("['scrape','crawl','crawl_status','map','search','parse','interact','monitor_create','monitor_list',"
          "'monitor_checks','optimize']")


@query("u1_merge_selections", f"""
with a as (select account_id, tool, min(ts) as f from requests where ts < timestamp '{SPLIT}' group by 1, 2),
b as (select account_id, tool, min(ts) as f from requests where ts >= timestamp '{SPLIT}' group by 1, 2),
u as (select account_id, tool, 0 as g, f from a
      union all
      select b.account_id, b.tool, 1, b.f from b
      where not exists (select 1 from a where a.account_id = b.account_id and a.tool = b.tool))
select account_id, string_agg(tool, ',' order by g, f, tool) as merged from u group by 1
""")
def u1_merge_selections(v):
    split = F.lit(SPLIT).cast("timestamp_ntz")
    r = v.requests
    active = U.first_use_order(r.where(F.col("ts") < split), "account_id", "tool", "ts", "active")
    selected = U.first_use_order(r.where(F.col("ts") >= split), "account_id", "tool", "ts", "selected")
    j = active.join(selected, "account_id", "full")
    empty = F.array().cast("array<string>")
    merged = U.merge_selections(F.coalesce("active", empty), F.coalesce("selected", empty))
    return j.select("account_id", F.array_join(merged, ",").alias("merged"))


@query("u2_order_selection", f"""
select account_id, array_to_string(list_filter({_CANON}, lambda t: list_contains(s, t)), ',') as ordered
from (select account_id, list(distinct tool) as s from requests where ts >= timestamp '{SPLIT}' group by 1) x
""")
def u2_order_selection(v):
    split = F.lit(SPLIT).cast("timestamp_ntz")
    sel = v.requests.where(F.col("ts") >= split).groupBy("account_id").agg(F.collect_set("tool").alias("s"))
    return sel.select("account_id", F.array_join(U.order_selection(F.col("s")), ",").alias("ordered"))


@query("u3_urls_in_both", "select url from capture_v1 intersect select url from capture_v2")
def u3_urls_in_both(v):
    return U.url_overlap(v.capture_v1, v.capture_v2, "both")


@query("u3_urls_only_v1", "select url from capture_v1 except select url from capture_v2")
def u3_urls_only_v1(v):
    return U.url_overlap(v.capture_v1, v.capture_v2, "only_a")


@query("u3_urls_only_v2", "select url from capture_v2 except select url from capture_v1")
def u3_urls_only_v2(v):
    return U.url_overlap(v.capture_v1, v.capture_v2, "only_b")


@query("u3_urls_either", "select url from capture_v1 union select url from capture_v2")
def u3_urls_either(v):
    return U.url_overlap(v.capture_v1, v.capture_v2, "either")
