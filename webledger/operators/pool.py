"""API-key pools: eligibility, ranking, selection, rotation and ledger updates
(F6, F7, N1-N5, R1-R8, C10).

A pool is the set of keys one account (here a nation) rotates through.  The
reference keeps one pool in memory and sorts it with comparators; here every
pool is ranked at once with a window per pool, and ledger changes are joins
on a hashed key id, never on the raw secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webledger.functions.exprs import num_text
from webledger.operators.windows import chunked_running_sum, running_sum, running_sums
from webledger.session import cut_lineage

FALLBACK_PRIORITY = 999
FALLBACK_NAME = "env-default"
DEFAULT_NEW_QUOTA = 1000
STRATEGIES = ("quota-first", "priority", "round-robin")


def key_hash(key_text: Column) -> Column:
    return F.sha2(key_text, 256)


def eligible_keys(keys: DataFrame) -> DataFrame:
    """drop disabled or blank keys."""
    return keys.where(~F.coalesce(F.col("disabled"), F.lit(False)) & (F.coalesce(F.col("key_text"), F.lit("")) != ""))


def exhausted(auto_disable: bool = True) -> Column:
    """F7 predicate: known remaining <= 0 (when auto-disable is on), or a
    non-zero quota used up (needs a usage row)."""
    by_remaining = F.col("remaining_credits").isNotNull() & (F.col("remaining_credits") <= 0)
    quota = F.col("monthly_quota")
    by_quota = (
        quota.isNotNull() & (quota != 0) & F.col("used_credits").isNotNull() & (F.col("used_credits") >= quota)
    )
    cond = by_quota if not auto_disable else (by_remaining | by_quota)
    return F.coalesce(cond, F.lit(False))


def unexhausted(keys: DataFrame, auto_disable: bool = True) -> DataFrame:
    return keys.where(~exhausted(auto_disable))


def rank_keys(keys: DataFrame, strategy: str = "quota-first", pool: str = "account_id", out: str = "rank",
              skew_safe: bool = False) -> DataFrame:
    """Rank per pool.  Ties keep input order (``key_id``); an unknown
    strategy keeps input order.

    ``skew_safe`` ranks with a running count over the global prefix scan
    instead of a window per pool, for pools too large for one task (key
    tables are normally small, so the window is the default)."""
    rem = F.coalesce(
        F.col("remaining_credits").cast("double"), F.col("monthly_quota").cast("double"), F.lit(float("inf"))
    )
    if strategy == "quota-first":
        asc = [-rem, F.col("priority"), F.col("key_id")]
    elif strategy == "priority":
        asc = [F.col("priority"), F.col("key_id")]
    elif strategy == "round-robin":
        asc = [F.coalesce(F.col("last_checked"), F.lit("")), F.col("key_id")]
    else:
        asc = [F.col("key_id")]
    if skew_safe:
        return running_sum(keys, [pool], asc, F.lit(1), out=out).withColumn(out, F.col(out).cast("bigint"))
    return keys.withColumn(out, F.row_number().over(Window.partitionBy(pool).orderBy(*asc)).cast("bigint"))


def select_key(ranked: DataFrame, start: int = 0, pool: str = "account_id", auto_disable: bool = True) -> DataFrame:
    """R2: first usable key scanning the ring from ``start``; null when every
    key of the pool is exhausted.  Ring size and choice are partial
    aggregates per pool (no window)."""
    n = ranked.groupBy(pool).agg(F.count(F.lit(1)).alias("_n"))
    scan = ranked.join(n, pool).withColumn("_pos", F.pmod(F.col("rank") - 1 - F.lit(start), F.col("_n")))
    ok = ~exhausted(auto_disable)
    return scan.groupBy(pool).agg(
        F.min(F.when(ok, F.struct(F.col("_pos"), F.col("key_id")))).getField("key_id").alias("selected_key_id")
    )


def next_key(ranked: DataFrame, pool: str = "account_id") -> DataFrame:
    """The key after each key in the ring (no exhaustion test); null for
    a one-key pool.  An equi join on rank + 1, wrapping to the pool's first
    key (no window)."""
    succ = ranked.select(pool, (F.col("rank") - 1).alias("rank"), F.col("key_id").alias("_succ"))
    ring = ranked.groupBy(pool).agg(F.count(F.lit(1)).alias("_n"), F.min_by("key_id", "rank").alias("_first"))
    j = ranked.join(succ, [pool, "rank"], "left").join(ring, pool)
    return j.withColumn(
        "next_key_id", F.when(F.col("_n") > 1, F.coalesce(F.col("_succ"), F.col("_first")))
    ).drop("_succ", "_n", "_first")


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """Outcome of a call from its first try and the one retry."""
    ok = lambda s: (s >= 200) & (s < 300)
    per = attempts.groupBy("request_id").agg(
        F.max(F.when(F.col("attempt") == 1, F.col("http_status"))).alias("first_status"),
        F.max(F.when(F.col("attempt") == 1, F.col("key_id"))).alias("first_key"),
        F.max(F.when(F.col("attempt") == 2, F.col("http_status"))).alias("retry_status"),
        F.max(F.when(F.col("attempt") == 2, F.col("key_id"))).alias("retry_key"),
    )
    s1, s2 = F.col("first_status"), F.col("retry_status")
    outcome = (
        F.when(s1 == 429, F.when(s2.isNull(), "failed_429").when(ok(s2), "ok_after_rotation").otherwise(
            "failed_after_rotation"))
        .when(ok(s1), "ok")
        .otherwise("failed")
    )
    served = F.when(outcome == "ok", F.col("first_key")).when(outcome == "ok_after_rotation", F.col("retry_key"))
    return per.select("request_id", outcome.alias("outcome"), served.alias("served_key_id"))


def mark_exhausted(keys: DataFrame, attempts: DataFrame) -> DataFrame:
    """Remaining -> 0 for keys whose 429 body says the monthly limit or
    quota is spent, only when the call rotated to another key and the key has
    a usage row."""
    body = F.lower(F.col("body"))
    limit_hit = (F.col("http_status") == 429) & (
        body.contains("monthly usage limit") | body.contains("quota exceeded")
    )
    rotated = attempts.where(F.col("attempt") == 2).select("request_id")
    hits = (
        attempts.where((F.col("attempt") == 1) & limit_hit)
        .join(rotated, "request_id", "left_semi")
        .select("key_id")
        .distinct()
    )
    flagged = keys.join(hits.withColumn("_hit", F.lit(True)), "key_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("used_credits").isNotNull()
    return flagged.withColumns(
        {
            "remaining_credits": F.when(hit, F.lit(0).cast("bigint")).otherwise(F.col("remaining_credits")),
            "marked_exhausted": hit,
        }
    ).drop("_hit")


def mask_keys(keys: DataFrame) -> DataFrame:
    """``name: first8...last4 (priority: p, quota: q|auto)``."""
    k = F.col("key_text")
    return keys.withColumn(
        "masked",
        F.format_string(
            "%s: %s...%s (priority: %s, quota: %s)",
            F.col("name"),
            F.substring(k, 1, 8),
            F.when(F.length(k) >= 4, F.substring(k, -4, 4)).otherwise(k),
            num_text(F.col("priority")),
            F.coalesce(num_text(F.col("monthly_quota")), F.lit("auto")),
        ),
    )


def keys_with_usage(config: DataFrame, usage: DataFrame) -> DataFrame:
    """Left lookup of each configured key's usage row by hashed key."""
    u = usage.select("key_hash", "used_credits", "remaining_credits", "last_checked")
    return config.withColumn("key_hash", key_hash(F.col("key_text"))).join(u, "key_hash", "left").withColumn(
        "has_usage", F.col("used_credits").isNotNull()
    )


def add_fallback_key(keys: DataFrame, fallback: DataFrame, pool: str = "account_id") -> DataFrame:
    """Append each pool's fallback key unless an *eligible* key already
    has the same text.  A fallback equal to a disabled key is re-added, as
    in the reference, and flagged."""
    elig = eligible_keys(keys)
    fb = fallback.join(elig.select(pool, "key_text"), [pool, "key_text"], "left_anti")
    disabled = keys.where(F.coalesce(F.col("disabled"), F.lit(False))).select(
        pool, "key_text", F.lit(True).alias("matches_disabled")
    ).distinct()
    fb = fb.join(disabled, [pool, "key_text"], "left").select(
        F.lit(None).cast("bigint").alias("key_id"),
        pool,
        F.lit(FALLBACK_NAME).alias("name"),
        "key_text",
        F.lit(FALLBACK_PRIORITY).alias("priority"),
        F.coalesce("matches_disabled", F.lit(False)).alias("matches_disabled"),
    )
    base = elig.select("key_id", pool, "name", "key_text", "priority", F.lit(False).alias("matches_disabled"))
    return base.unionByName(fb)


def insert_new_keys(keys: DataFrame, candidates: DataFrame, pool: str = "account_id") -> DataFrame:
    """Add candidates in id order, rejecting those whose quota check failed
    (``quota_error``, where there is such a column) and key texts already present
    (configured or added earlier in the batch).  Quota = plan credits or
    1000; priority = pool size + i; name suffix continues after the highest
    existing ``key-N`` (so a name never repeats after a removal)."""
    if "quota_error" in candidates.columns:
        candidates = candidates.where(F.col("quota_error").isNull())
    if "remaining_credits" not in candidates.columns:
        candidates = candidates.withColumn("remaining_credits", F.lit(None).cast("bigint"))
    first_offer = (
        candidates.groupBy(pool, "key_text")
        .agg(F.min_by(F.struct("candidate_id", "plan_credits", "remaining_credits"), "candidate_id").alias("c"))
        .select(pool, "key_text", "c.*")
    )
    fresh = first_offer.join(keys.select(pool, "key_text"), [pool, "key_text"], "left_anti")
    sizes = keys.groupBy(pool).agg(
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(
            F.max(F.regexp_extract("name", r"^key-([0-9]+)$", 1).try_cast("bigint")), F.lit(0)
        ).alias("_max_suffix"),
    )
    # i-th accepted candidate of its pool: a running count (no window per pool).
    added = running_sum(fresh.join(sizes, pool, "left"), [pool], ["candidate_id"], F.lit(1), out="_i")
    n = F.coalesce(F.col("_n"), F.lit(0))
    return added.select(
        "candidate_id",
        pool,
        "key_text",
        F.concat(F.lit("key-"), (F.greatest(n, F.coalesce("_max_suffix", F.lit(0))) + F.col("_i")).cast("string")).alias(
            "name"),
        (n + F.col("_i")).cast("int").alias("priority"),
        F.coalesce(F.col("plan_credits"), F.lit(DEFAULT_NEW_QUOTA)).cast("bigint").alias("monthly_quota"),
        F.lit(False).alias("disabled"),
        "plan_credits",
        "remaining_credits",
    )


def usage_of_new_keys(added: DataFrame, as_of: Column) -> DataFrame:
    """The usage rows of keys that ``insert_new_keys`` added: what the plan
    has no longer left, or nothing used without a plan."""
    plan = F.col("plan_credits")
    used = F.when(plan.isNotNull() & (plan != 0), plan - F.coalesce("remaining_credits", F.lit(0))).otherwise(F.lit(0))
    return added.select(
        key_hash(F.col("key_text")).alias("key_hash"), used.cast("bigint").alias("used_credits"), "remaining_credits",
        "plan_credits", as_of.alias("last_checked"),
    )


def remove_keys(keys: DataFrame, names: DataFrame, pool: str = "account_id") -> tuple[DataFrame, DataFrame]:
    """Delete the first key (lowest id) of each requested name per pool;
    report requested names that match nothing."""
    req = names.select(pool, "name").distinct()
    first = keys.groupBy(pool, "name").agg(F.min("key_id").alias("key_id"))
    doomed = first.join(req, [pool, "name"], "left_semi").select("key_id")
    remaining = keys.join(doomed, "key_id", "left_anti")
    not_found = req.join(keys.select(pool, "name"), [pool, "name"], "left_anti")
    return remaining, not_found


def refresh_quota(usage: DataFrame, feed: DataFrame) -> DataFrame:
    """Apply a quota feed.  used = plan - coalesce(remaining, 0) when the
    plan is non-zero, else the old used (else 0); an answer with an error
    changes nothing; keys new to the ledger are created."""
    f = feed.where(F.col("error").isNull()).select(
        "key_hash",
        F.col("remaining_credits").alias("f_remaining"),
        F.col("plan_credits").alias("f_plan"),
        F.lit(True).alias("_fed"),
    )
    u = usage.select("key_hash", "used_credits", "remaining_credits", "plan_credits")
    j = u.join(f, "key_hash", "full")
    fed = F.coalesce(F.col("_fed"), F.lit(False))
    plan = F.col("f_plan")
    new_used = F.when(
        plan.isNotNull() & (plan != 0), plan - F.coalesce(F.col("f_remaining"), F.lit(0))
    ).otherwise(F.coalesce(F.col("used_credits"), F.lit(0)))
    return j.select(
        "key_hash",
        F.when(fed, new_used).otherwise(F.col("used_credits")).cast("bigint").alias("used_credits"),
        F.when(fed, F.col("f_remaining")).otherwise(F.col("remaining_credits")).cast("bigint").alias(
            "remaining_credits"),
        F.when(fed, F.col("f_plan")).otherwise(F.col("plan_credits")).cast("bigint").alias("plan_credits"),
        fed.alias("refreshed"),
    )


def top_spenders(priced: DataFrame, k: int = 10) -> DataFrame:
    """The k accounts with the most credits (ties by account id); the
    limit is the feature, planned as a distributed top-k."""
    return (
        priced.groupBy("account_id")
        .agg(F.sum("estimated_credits").alias("credits"))
        .orderBy(F.col("credits").desc(), F.col("account_id").asc())
        .limit(k)
    )


def burn_down(priced: DataFrame, accounts: DataFrame) -> DataFrame:
    """Running credits per account-month, over-budget flag and the
    first request over budget (budget > 0 only)."""
    with_month = priced.withColumn("month", F.date_trunc("month", F.col("ts")).cast("date"))
    # The budget joins the hourly totals of an account, not its requests.
    j = chunked_running_sum(
        with_month,
        ["account_id", "month"],
        ["ts", "request_id"],
        "estimated_credits",
        {"_hour": F.date_trunc("hour", F.col("ts"))},
        out="running_credits",
        carry=(accounts.select("account_id", "monthly_budget"), ["account_id"]),
    )
    budget = F.col("monthly_budget")
    over = F.coalesce((budget > 0) & (F.col("running_credits") > budget), F.lit(False))
    first = over & ~F.coalesce(
        (budget > 0) & (F.col("running_credits") - F.col("estimated_credits") > budget), F.lit(False)
    )
    return j.select(
        "request_id", "account_id", "month", F.col("running_credits").cast("bigint").alias("running_credits"),
        over.alias("over_budget"), first.alias("first_over_budget"),
    )


def rolling_spend(priced: DataFrame, days: int = 7) -> DataFrame:
    """Spend per account-day and over the trailing ``days`` days.  The
    log is pre-aggregated to one row per account-day before the window, so
    the window sorts days, not requests."""
    daily = priced.groupBy("account_id", F.to_date("ts").alias("day")).agg(
        F.sum("estimated_credits").cast("bigint").alias("day_credits")
    )
    w = Window.partitionBy("account_id").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return daily.withColumn("rolling_credits", F.sum("day_credits").over(w).cast("bigint"))


def allocate_budget(demand: DataFrame, keys: DataFrame, order: list[str], chunk: dict[str, Column], pool: str = "pool",
                    bucket_min: int = 1024, buckets_per_pool: int = 4096) -> DataFrame:
    """Fill keys in ascending capacity with demand in ``order``; overflow
    spills to the next key, and what exceeds every key stays unallocated (key
    null).  Keys without a known capacity are unlimited; the first of them
    (by id) takes all overflow.

    ``demand``: request_id, pool, credits and the ``order`` columns; ``chunk``
    cuts that order into stretches (see ``chunked_running_sum``).  Both sides
    become intervals on a per-pool credit axis and meet in an equi join on (pool, bucket) with an
    overlap filter, never a nested loop.  Output: one row per share.
    """
    cap = F.greatest(F.lit(0), F.coalesce(F.col("remaining_credits"), F.col("monthly_quota") - F.col("used_credits")))
    # Keys in ascending capacity (unknown capacity last), as a running
    # capacity and a running count - one prefix scan, no window per pool.
    k = keys.select("key_id", F.col("account_id").alias(pool), cap.alias("capacity"))
    k = running_sums(
        k, [pool], [F.col("capacity").isNull().cast("int"), F.coalesce(F.col("capacity"), F.lit(0)), "key_id"],
        {"_run": F.coalesce(F.col("capacity"), F.lit(0)), "_rn": F.lit(1)},
    ).withColumn("_run", F.when(F.col("capacity").isNotNull(), F.col("_run")))
    fin = k.groupBy(pool).agg(
        F.coalesce(F.sum("capacity"), F.lit(0)).alias("finite_capacity"),
        F.count(F.when(F.col("capacity").isNotNull(), 1)).alias("_n_finite"),
        F.max(F.col("capacity").isNull().cast("int")).alias("has_unlimited"),
    )
    totals = demand.groupBy(pool).agg(F.sum("credits").alias("total_demand"))
    sizes = totals.withColumn(
        "bsize", F.greatest(F.lit(bucket_min), F.ceil(F.col("total_demand") / F.lit(buckets_per_pool))).cast("bigint")
    )
    # The demand intervals feed the bucket join and the overflow rows; they
    # are written once to the shared checkpoint folder rather than having the
    # running-sum windows recomputed for each consumer.  What they need of
    # their pool comes with the totals of its stretches, not by a join of all
    # demand on the pool.
    d = chunked_running_sum(demand, [pool], [*order, "request_id"], "credits", chunk, out="d1",
                            carry=(sizes.select(pool, "bsize").join(fin, pool, "left"), [pool]))
    d = cut_lineage(d.withColumn("d0", F.col("d1") - F.col("credits")).select(
        "request_id", pool, "credits", "d0", "d1", "bsize", "finite_capacity", "has_unlimited"))
    k = k.join(fin, pool).join(sizes, pool)
    unlimited = F.col("capacity").isNull()
    first_unlimited = unlimited & (F.col("_rn") == F.col("_n_finite") + 1)
    k = k.withColumns(
        {
            "k0": F.when(unlimited, F.col("finite_capacity")).otherwise(F.col("_run") - F.col("capacity")),
            "k1": F.when(first_unlimited, F.greatest("total_demand", "finite_capacity"))
            .when(unlimited, F.col("finite_capacity"))
            .otherwise(F.col("_run")),
        }
    )
    # Key intervals are clipped to the pool's demand: a key far larger than
    # the demand would otherwise explode into buckets nobody asks for.  With
    # that, a pool has at most about ``buckets_per_pool`` + keys buckets.
    k = k.withColumn("k1", F.least(F.col("k1"), F.col("total_demand")))
    kb = k.where(F.col("k1") > F.col("k0")).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("k0") / F.col("bsize")),
                                       F.floor((F.col("k1") - 1) / F.col("bsize"))))
    )
    db = d.select("request_id", pool, "credits", "d0", "d1", "bsize").where(F.col("credits") > 0).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("d0") / F.col("bsize")),
                                       F.floor((F.col("d1") - 1) / F.col("bsize"))))
    )
    pairs = db.alias("a").join(kb.select(pool, "bucket", "key_id", "k0", "k1").alias("b"), [pool, "bucket"]).where(
        (F.col("a.d0") < F.col("b.k1"))
        & (F.col("b.k0") < F.col("a.d1"))
        & (F.col("bucket") == F.greatest(F.floor(F.col("a.d0") / F.col("a.bsize")),
                                         F.floor(F.col("b.k0") / F.col("a.bsize"))))
    )
    shares = pairs.select(
        "request_id", pool, "key_id", (F.least("d1", "k1") - F.greatest("d0", "k0")).cast("bigint").alias("allocated")
    )
    fc = F.coalesce(F.col("finite_capacity"), F.lit(0))
    rest = d.where(
        ~F.coalesce(F.col("has_unlimited") == 1, F.lit(False)) & (F.col("d1") > fc)
    ).select(
        "request_id", pool, F.lit(None).cast("bigint").alias("key_id"),
        (F.col("d1") - F.greatest(F.col("d0"), fc)).cast("bigint").alias("allocated"),
    )
    return shares.unionByName(rest)
