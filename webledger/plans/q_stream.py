"""Batch twins of the streaming jobs (T1, T2, T5, T8); the stream forms are
checked against these in tests/test_streaming.py."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from webledger.operators import cost
from webledger.plans.registry import query
from webledger.plans.q_cache import _REPLAY_SQL, replay_log
from webledger.sources.tables import read_files, state_path
from webledger.streaming import jobs as J


@query("t1_spend_windows_tumbling", """
select make_timestamp(b) as window_start, make_timestamp(b + 86400000000) as window_end, account_id,
  cast(sum(estimated_credits) as bigint) as credits, count(*) as calls
from (select account_id, estimated_credits, cast(floor(epoch_us(ts) / 86400000000) as bigint) * 86400000000 as b
      from priced) p
group by 1, 2, 3
""")
def t1_spend_windows_tumbling(v):
    return J.spend_windows(cost.priced_requests(v.requests), "1 day")


@query("t1_spend_windows_sliding", """
select make_timestamp(b) as window_start, make_timestamp(b + 86400000000) as window_end, account_id,
  cast(sum(estimated_credits) as bigint) as credits, count(*) as calls
from (select account_id, estimated_credits,
             unnest([k, k - 43200000000]) as b
      from (select *, cast(floor(epoch_us(ts) / 43200000000) as bigint) * 43200000000 as k from priced) q) p
group by 1, 2, 3
""")
def t1_spend_windows_sliding(v):
    return J.spend_windows(cost.priced_requests(v.requests), "1 day", "12 hours")


_SESSIONS_SQL = """
with recursive ord as (
  select account_id, epoch_us(ts) as us, row_number() over (partition by account_id order by ts, request_id) as rn
  from requests where tool = 'interact'),
walk as (
  select account_id, rn, us, us as s from ord where rn = 1
  union all
  select o.account_id, o.rn, o.us,
    case when o.us - w.us >= 3600000000 or o.us >= w.s + 1800000000 then o.us else w.s end
  from walk w join ord o on o.account_id = w.account_id and o.rn = w.rn + 1),
x as (
  select account_id, s, count(*) as n_events, least(max(us) - s + 3600000000, 1800000000) as l from walk group by 1, 2)
select account_id, make_timestamp(s) as session_start, make_timestamp(s + l) as session_end, n_events,
  cast(ceil(l / 1000000.0) as bigint) as billed_seconds, cast(ceil(l / 60000000.0) * 2 as bigint) as credits
from x
"""


@query("t2_interact_sessions", _SESSIONS_SQL)
def t2_interact_sessions(v):
    return J.interact_sessions(v.requests, activity_ttl=3600, ttl=1800)


@query("t2_interact_sessions_scan", _SESSIONS_SQL)
def t2_interact_sessions_scan(v):
    return J.interact_sessions_scan(v.requests, activity_ttl=3600, ttl=1800)


@query("t5_exhaustion", """
select key_id, count(*) filter (where http_status between 200 and 299) as successes,
  count(*) filter (where http_status = 429 and (contains(lower(body), 'monthly usage limit')
                   or contains(lower(body), 'quota exceeded'))) as limit_hits,
  bool_or(http_status = 429 and (contains(lower(body), 'monthly usage limit')
          or contains(lower(body), 'quota exceeded'))) as exhausted
from attempts group by 1
""")
def t5_exhaustion(v):
    return J.stream_exhaustion(v.attempts)


@query("t8_match_responses", """
select r.request_id, r.ts as req_ts, s.ts as resp_ts, s.http_status, s.ts is null as lost
from requests r left join (
  select request_id, ts + to_seconds(request_id % 90) as ts, http_status from requests where http_status <> 500) s
  on s.request_id = r.request_id and s.ts >= r.ts and s.ts <= r.ts + interval 60 seconds
""")
def t8_match_responses(v):
    return J.match_responses(v.requests, J.responses_of(v.requests), within_seconds=60)


# Streams run to their end over files written from the given tables ----------------


def _run(v, df, label, build, **how):
    return J.run_over(df, state_path(v.spark, label), build, **how)


@query("s2_read_files", """
select page_id // 100 as part, cast(sum(strlen(html) + 1) as bigint) as bytes, 'txt' as file_type from pages group by 1
""")
def s2_read_files(v):
    """Pages written as text files, a hundred to each, and read back as bytes."""
    path = state_path(v.spark, "files")
    pages = v.table("pages").select(F.expr("page_id div 100").alias("part"), "html")
    pages.repartition("part").write.partitionBy("part").text(path)
    files = read_files(v.spark, path, glob="*.txt")
    part = F.regexp_extract("path", "/part=([0-9]+)/", 1).cast("bigint")
    return files.groupBy(part.alias("part")).agg(F.sum("length").alias("bytes"), F.max("file_type").alias("file_type"))


@query("s6_request_stream", "select request_id, ts, tool, http_status from requests")
def s6_request_stream(v):
    r = v.requests.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return _run(v, r, "requests", lambda s: s.select("request_id", "ts", "tool", "http_status"), order="us")


#: A time after all of the tables'.
_END = dt.datetime(2100, 1, 1)


@query("t2_stream_sessions", _SESSIONS_SQL)
def t2_stream_sessions(v):
    """Interact requests through the stream of sessions, in batches whose times overlap by a third of the log."""
    r = v.requests.select("request_id", "account_id", "tool", "ts").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    end = {"request_id": -1, "account_id": -1, "tool": "interact", "ts": _END}
    return _run(v, r, "sessions", lambda s: J.stream_sessions(s, 3600, 1800, "40 days"), order="us", slices=4, shuffled=True, end=end)


@query("t3_stream_cache", _REPLAY_SQL + "select request_id, url, hit, reason from walk")
def t3_stream_cache(v):
    """The request log replayed through the cache as a stream, in batches out of time order."""
    log = replay_log(v).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    end = {"request_id": -1, "url": "", "format": "markdown", "ts": _END, "tool": "scrape", "credits": 0}
    return _run(v, log, "cache-log", lambda s: J.stream_cache(s.drop("us"), watermark="40 days"), order="us", slices=4, shuffled=True, end=end)


@query("t4_stream_changes", """
select url, cast(1 as bigint) as capture, 'new' as status from capture_v1
union all
select n.url, 2, case when o.url is null then 'new' else 'changed' end
from capture_v2 n left join capture_v1 o on o.url = n.url where o.url is null or o.html <> n.html
""")
def t4_stream_changes(v):
    """Both captures of all pages, a day apart; half of the first ones arrive with the second ones."""
    caps = v.capture_v1.withColumn("capture", F.lit(1).cast("long")).unionByName(
        v.capture_v2.withColumn("capture", F.lit(2).cast("long")))
    caps = caps.withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("capture") * 86_400).cast("timestamp_ntz"))
    end = {"url": "", "html": "", "capture": 3, "ts": _END}
    return _run(v, caps, "captures", lambda s: J.stream_changes(s, "2 days"), order="capture", slices=2, shuffled=True, end=end)


@query("t5_exhaustion_marks", """
select distinct a.key_id from attempts a
where a.attempt = 1 and a.http_status = 429
  and (contains(lower(a.body), 'monthly usage limit') or contains(lower(a.body), 'quota exceeded'))
  and exists (select 1 from attempts b where b.request_id = a.request_id and b.attempt = 2)
""")
def t5_exhaustion_marks(v):
    """Keys marked by the stream; the same keys as R5 finds."""
    at = v.attempts.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    marks = _run(v, at, "attempts", lambda s: J.stream_exhaustion_marks(J.event_time(s), watermark="1 hour"), order="us")
    return marks.select("key_id").distinct()


@query("t5_quota_exhaustion", """
select k.key_id, k.used_credits + s.n as used, coalesce(k.monthly_quota <> 0 and k.used_credits + s.n >= k.monthly_quota, false) as quota_spent
from keys k join (select key_id, count(*) filter (where http_status between 200 and 299) as n from attempts group by 1) s
  on s.key_id = k.key_id
""")
def t5_quota_exhaustion(v):
    usage = _run(v, v.attempts, "tries", J.stream_exhaustion, mode="update", key=["key_id"], order="request_id")
    return J.quota_exhaustion(usage, v.keys)


@query("t6_stream_crawl_progress", """
select job_id, count(*) as total, count(*) filter (where status = 'completed') as completed from job_pages group by 1
""")
def t6_stream_crawl_progress(v):
    return _run(v, v.job_pages, "job-pages", J.stream_crawl_progress, mode="update", key=["job_id"], order="page_no")


@query("t7_dedupe_stream", "select distinct account_id, tool, format from requests")
def t7_dedupe_stream(v):
    """Repeats within a time longer than the log: one row for each key."""
    r = v.requests.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    keys = ["account_id", "tool", "format"]
    return _run(v, r, "repeats", lambda s: J.dedupe_stream(J.event_time(s), keys, "4000 days").select(*keys), order="us")
