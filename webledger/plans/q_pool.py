"""Queries over API-key pools."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.operators import cost, pool
from webledger.plans.oracle import view
from webledger.plans.registry import query

_ELIGIBLE = "not coalesce(disabled, false) and coalesce(key_text, '') <> ''"
_EXHAUSTED = ("((remaining_credits is not null and remaining_credits <= 0) or (monthly_quota is not null "
              "and monthly_quota <> 0 and used_credits is not null and used_credits >= monthly_quota))")
_RANK_QF = ("row_number() over (partition by account_id order by coalesce(cast(remaining_credits as double), "
            "cast(monthly_quota as double), cast('infinity' as double)) desc, priority, key_id)")

view("key_usage", """
select sha256(key_text) as key_hash, used_credits, remaining_credits, monthly_quota as plan_credits, last_checked
from keys where last_checked <> ''
""")

view("fallback_keys", """
select account_id, case when account_id % 2 = 0 then concat('wk-env-', account_id)
                        else arg_min(key_text, key_id) end as key_text
from keys group by account_id
""")


def key_usage(v):
    """The usage ledger: one row per key that has been used, keyed by hash."""
    return v.keys.where(F.col("last_checked") != "").select(
        pool.key_hash(F.col("key_text")).alias("key_hash"), "used_credits", "remaining_credits",
        F.col("monthly_quota").alias("plan_credits"), "last_checked",
    )


def fallback_keys(v):
    per = v.keys.groupBy("account_id").agg(F.min_by("key_text", "key_id").alias("first_key"))
    return per.select(
        "account_id",
        F.when(F.col("account_id") % 2 == 0, F.concat(F.lit("wk-env-"), F.col("account_id").cast("string")))
        .otherwise(F.col("first_key")).alias("key_text"),
    )


@query("f6_eligible_keys", f"select key_id, account_id from keys where {_ELIGIBLE}")
def f6_eligible_keys(v):
    return pool.eligible_keys(v.keys).select("key_id", "account_id")


@query("f7_unexhausted_unused", f"""
select key_id, account_id from (
  select * replace (case when key_id % 6 <> 5 then used_credits end as used_credits) from keys) k
where {_ELIGIBLE} and not {_EXHAUSTED}
""")
def f7_unexhausted_unused(v):
    """Every sixth key has no usage row: its quota can't be known to be spent."""
    k = v.keys.withColumn("used_credits", F.when(F.col("key_id") % 6 != 5, F.col("used_credits")))
    return pool.unexhausted(pool.eligible_keys(k)).select("key_id", "account_id")


@query("f7_unexhausted", f"select key_id, account_id from keys where {_ELIGIBLE} and not {_EXHAUSTED}")
def f7_unexhausted(v):
    return pool.unexhausted(pool.eligible_keys(v.keys)).select("key_id", "account_id")


@query("f7_unexhausted_no_auto_disable", f"""
select key_id, account_id from keys where {_ELIGIBLE}
  and not coalesce(monthly_quota is not null and monthly_quota <> 0 and used_credits is not null
                   and used_credits >= monthly_quota, false)
""")
def f7_unexhausted_no_auto_disable(v):
    return pool.unexhausted(pool.eligible_keys(v.keys), auto_disable=False).select("key_id", "account_id")


@query("n1_keys_with_usage", """
select k.key_id, u.used_credits is not null as has_usage, u.used_credits, u.remaining_credits, u.last_checked
from keys k left join key_usage u on u.key_hash = sha256(k.key_text)
""")
def n1_keys_with_usage(v):
    config = v.keys.select("key_id", "account_id", "name", "key_text", "priority", "monthly_quota", "disabled")
    out = pool.keys_with_usage(config, key_usage(v))
    return out.select("key_id", "has_usage", "used_credits", "remaining_credits", "last_checked")


@query("n2_add_fallback_key", f"""
select key_id, account_id, name, sha256(key_text) as key_hash, priority, false as matches_disabled from keys where {_ELIGIBLE}
union all
select cast(null as bigint), f.account_id, 'env-default', sha256(f.key_text), 999,
  exists (select 1 from keys k where k.account_id = f.account_id and k.key_text = f.key_text
          and coalesce(k.disabled, false))
from fallback_keys f
where not exists (select 1 from keys e where e.account_id = f.account_id and e.key_text = f.key_text and {_ELIGIBLE.replace('disabled', 'e.disabled').replace('key_text', 'e.key_text')})
""")
def n2_add_fallback_key(v):
    # Reports show key hashes, never key texts (only R6 shows a masked key).
    out = pool.add_fallback_key(v.keys, fallback_keys(v))
    return out.select("key_id", "account_id", "name", pool.key_hash(F.col("key_text")).alias("key_hash"), "priority",
                      "matches_disabled")


@query("n3_insert_new_keys", """
select f.candidate_id, f.account_id, sha256(f.key_text) as key_hash,
  concat('key-', greatest(coalesce(s.n, 0), coalesce(s.max_suffix, 0))
                 + row_number() over (partition by f.account_id order by f.candidate_id)) as name,
  cast(coalesce(s.n, 0) + row_number() over (partition by f.account_id order by f.candidate_id) as int) as priority,
  cast(coalesce(f.plan_credits, 1000) as bigint) as monthly_quota, false as disabled
from (select * from (select *, row_number() over (partition by account_id, key_text order by candidate_id) as rn
                     from key_candidates where quota_error is null) c where rn = 1) f
left join (select account_id, count(*) as n,
                  coalesce(max(try_cast(regexp_extract(name, '^key-([0-9]+)$', 1) as bigint)), 0) as max_suffix
           from keys group by 1) s on s.account_id = f.account_id
where not exists (select 1 from keys k where k.account_id = f.account_id and k.key_text = f.key_text)
""")
def n3_insert_new_keys(v):
    out = pool.insert_new_keys(v.keys, v.key_candidates)
    return out.select("candidate_id", "account_id", pool.key_hash(F.col("key_text")).alias("key_hash"), "name",
                      "priority", "monthly_quota", "disabled")


@query("n3_usage_of_new_keys", """
select sha256(f.key_text) as key_hash,
  case when coalesce(f.plan_credits, 0) <> 0 then f.plan_credits - coalesce(f.remaining_credits, 0) else 0 end as used_credits,
  f.remaining_credits, f.plan_credits, timestamp '2024-02-01 00:00:00' as last_checked
from (select *, row_number() over (partition by account_id, key_text order by candidate_id) as rn
      from key_candidates where quota_error is null) f
where rn = 1 and not exists (select 1 from keys k where k.account_id = f.account_id and k.key_text = f.key_text)
""")
def n3_usage_of_new_keys(v):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return pool.usage_of_new_keys(pool.insert_new_keys(v.keys, v.key_candidates), as_of)


@query("n4_remove_keys_remaining", """
select key_id, account_id, name from keys
where key_id not in (select min(k.key_id) from keys k
                     join (select distinct account_id, name from key_removals) r
                       on r.account_id = k.account_id and r.name = k.name
                     group by k.account_id, k.name)
""")
def n4_remove_keys_remaining(v):
    remaining, _ = pool.remove_keys(v.keys, v.key_removals)
    return remaining.select("key_id", "account_id", "name")


@query("n4_remove_keys_not_found", """
select distinct account_id, name from key_removals r
where not exists (select 1 from keys k where k.account_id = r.account_id and k.name = r.name)
""")
def n4_remove_keys_not_found(v):
    _, not_found = pool.remove_keys(v.keys, v.key_removals)
    return not_found


@query("n5_refresh_quota", """
select coalesce(u.key_hash, f.key_hash) as key_hash,
  cast(case when f.key_hash is not null
            then case when f.plan_credits is not null and f.plan_credits <> 0
                      then f.plan_credits - coalesce(f.remaining_credits, 0) else coalesce(u.used_credits, 0) end
            else u.used_credits end as bigint) as used_credits,
  case when f.key_hash is not null then f.remaining_credits else u.remaining_credits end as remaining_credits,
  case when f.key_hash is not null then f.plan_credits else u.plan_credits end as plan_credits,
  f.key_hash is not null as refreshed
from key_usage u
full outer join (select sha256(key_text) as key_hash, remaining_credits, plan_credits
                 from key_feed where error is null) f on u.key_hash = f.key_hash
""")
def n5_refresh_quota(v):
    feed = v.key_feed.withColumn("key_hash", pool.key_hash(F.col("key_text")))
    return pool.refresh_quota(key_usage(v), feed)


@query("r1_rank_keys", f"""
select key_id, account_id, {_RANK_QF} as rank_quota_first,
  row_number() over (partition by account_id order by priority, key_id) as rank_priority,
  row_number() over (partition by account_id order by coalesce(last_checked, ''), key_id) as rank_round_robin
from keys where {_ELIGIBLE}
""")
def r1_rank_keys(v):
    k = pool.eligible_keys(v.keys)
    k = pool.rank_keys(k, "quota-first", out="rank_quota_first")
    k = pool.rank_keys(k, "priority", out="rank_priority")
    k = pool.rank_keys(k, "round-robin", out="rank_round_robin")
    return k.select("key_id", "account_id", "rank_quota_first", "rank_priority", "rank_round_robin")


_SELECT_SQL = f"""
select account_id, arg_min(key_id, ((rnk - 1 - {{start}}) % n + n) % n) filter (where not {_EXHAUSTED}) as selected_key_id
from (select *, {_RANK_QF} as rnk, count(*) over (partition by account_id) as n from keys where {_ELIGIBLE}) r
group by account_id
"""


@query("r2_select_key", _SELECT_SQL.format(start=0))
def r2_select_key(v):
    return pool.select_key(pool.rank_keys(pool.eligible_keys(v.keys)), start=0)


@query("r2_select_key_start2", _SELECT_SQL.format(start=2))
def r2_select_key_start2(v):
    return pool.select_key(pool.rank_keys(pool.eligible_keys(v.keys)), start=2)


@query("r3_next_key", f"""
select key_id, account_id,
  case when count(*) over (partition by account_id) > 1
       then coalesce(lead(key_id) over (partition by account_id order by rnk),
                     first_value(key_id) over (partition by account_id order by rnk)) end as next_key_id
from (select *, {_RANK_QF} as rnk from keys where {_ELIGIBLE}) r
""")
def r3_next_key(v):
    return pool.next_key(pool.rank_keys(pool.eligible_keys(v.keys))).select("key_id", "account_id", "next_key_id")


@query("r4_resolve_attempts", """
select request_id,
  case when s1 = 429 then case when s2 is null then 'failed_429' when s2 between 200 and 299 then 'ok_after_rotation'
                               else 'failed_after_rotation' end
       when s1 between 200 and 299 then 'ok' else 'failed' end as outcome,
  case when s1 between 200 and 299 then k1 when s1 = 429 and s2 between 200 and 299 then k2 end as served_key_id
from (select request_id, max(case when attempt = 1 then http_status end) as s1,
             max(case when attempt = 1 then key_id end) as k1,
             max(case when attempt = 2 then http_status end) as s2,
             max(case when attempt = 2 then key_id end) as k2
      from attempts group by 1) a
""")
def r4_resolve_attempts(v):
    return pool.resolve_attempts(v.attempts)


@query("r5_mark_exhausted", """
select key_id,
  case when hit then cast(0 as bigint) else remaining_credits end as remaining_credits, hit as marked_exhausted
from (select k.*, k.used_credits is not null and k.key_id in (
        select a.key_id from attempts a
        where a.attempt = 1 and a.http_status = 429
          and (contains(lower(a.body), 'monthly usage limit') or contains(lower(a.body), 'quota exceeded'))
          and exists (select 1 from attempts b where b.request_id = a.request_id and b.attempt = 2)) as hit
      from keys k) x
""")
def r5_mark_exhausted(v):
    return pool.mark_exhausted(v.keys, v.attempts).select("key_id", "remaining_credits", "marked_exhausted")


@query("r6_mask_keys", """
select key_id, concat(name, ': ', substr(key_text, 1, 8), '...', right(key_text, 4), ' (priority: ', priority,
                      ', quota: ', coalesce(cast(monthly_quota as varchar), 'auto'), ')') as masked
from keys
""")
def r6_mask_keys(v):
    return pool.mask_keys(v.keys).select("key_id", "masked")


@query("r7_top_spenders", """
select account_id, cast(sum(estimated_credits) as bigint) as credits from priced
group by 1 order by credits desc, account_id limit 10
""")
def r7_top_spenders(v):
    return pool.top_spenders(cost.priced_requests(v.requests), 10)


@query("r8_burn_down", """
select request_id, account_id, month, running_credits,
  coalesce(monthly_budget > 0 and running_credits > monthly_budget, false) as over_budget,
  coalesce(monthly_budget > 0 and running_credits > monthly_budget, false)
    and not coalesce(monthly_budget > 0 and running_credits - estimated_credits > monthly_budget, false) as first_over_budget
from (select p.request_id, p.account_id, cast(date_trunc('month', p.ts) as date) as month, p.estimated_credits,
        cast(sum(p.estimated_credits) over (partition by p.account_id, date_trunc('month', p.ts)
             order by p.ts, p.request_id rows between unbounded preceding and current row) as bigint) as running_credits,
        a.monthly_budget
      from priced p left join accounts a on a.account_id = p.account_id) x
""")
def r8_burn_down(v):
    return pool.burn_down(cost.priced_requests(v.requests), v.accounts)


@query("r8_rolling_spend", """
select account_id, day, day_credits,
  cast(sum(day_credits) over (partition by account_id order by day
       range between interval 6 days preceding and current row) as bigint) as rolling_credits
from (select account_id, cast(ts as date) as day, cast(sum(estimated_credits) as bigint) as day_credits
      from priced group by 1, 2) d
""")
def r8_rolling_spend(v):
    return pool.rolling_spend(cost.priced_requests(v.requests), 7)


@query("c10_allocate_budget", f"""
with d as (
  select request_id, pool, credits, d1, d1 - credits as d0 from (
    select r.request_id, a.nation_id as pool, r.estimated_credits as credits,
      sum(r.estimated_credits) over (partition by a.nation_id
        order by case when r.tool in ('scrape', 'crawl', 'search', 'map') then 0 else 1 end, r.ts, r.request_id
        rows between unbounded preceding and current row) as d1
    from priced r join accounts a on a.account_id = r.account_id) x),
k as (
  select key_id, account_id as pool, greatest(0, coalesce(remaining_credits, monthly_quota - used_credits)) as capacity
  from keys where {_ELIGIBLE}),
fin as (select pool, coalesce(sum(capacity), 0) as finite_capacity, max(case when capacity is null then 1 else 0 end) as has_unlimited
        from k group by pool),
tot as (select pool, max(d1) as total_demand from d group by pool),
kk as (
  select key_id, pool, sum(capacity) over (partition by pool order by capacity, key_id
                                           rows between unbounded preceding and current row) - capacity as k0,
         sum(capacity) over (partition by pool order by capacity, key_id
                             rows between unbounded preceding and current row) as k1
  from k where capacity is not null
  union all
  select u.key_id, u.pool, f.finite_capacity as k0, greatest(t.total_demand, f.finite_capacity) as k1
  from (select *, row_number() over (partition by pool order by key_id) as rn from k where capacity is null) u
  join fin f on f.pool = u.pool join tot t on t.pool = u.pool
  where u.rn = 1)
select d.request_id, d.pool, kk.key_id, cast(least(d.d1, kk.k1) - greatest(d.d0, kk.k0) as bigint) as allocated
from d join kk on kk.pool = d.pool and d.d0 < kk.k1 and kk.k0 < d.d1
where d.credits > 0
union all
select d.request_id, d.pool, cast(null as bigint),
  cast(d.d1 - greatest(d.d0, coalesce(f.finite_capacity, 0)) as bigint)
from d left join fin f on f.pool = d.pool
where coalesce(f.has_unlimited, 0) = 0 and d.d1 > coalesce(f.finite_capacity, 0)
""")
def c10_allocate_budget(v):
    priced = cost.priced_requests(v.requests).join(
        v.accounts.select("account_id", F.col("nation_id").alias("pool")), "account_id"
    )
    light = F.when(F.col("tool").isin(*cost.LIGHT_TOOLS), 0).otherwise(1)
    demand = priced.select(
        "request_id", "pool", "ts", F.col("estimated_credits").alias("credits"), light.alias("light_rank"),
    )
    chunk = {"_light": F.col("light_rank"), "_hour": F.date_trunc("hour", F.col("ts"))}
    return pool.allocate_budget(demand, pool.eligible_keys(v.keys), ["light_rank", "ts"], chunk)
