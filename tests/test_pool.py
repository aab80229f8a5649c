"""Key pools: ranking ties, selection, rotation, ledger updates, allocation."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from webledger.operators import pool

KEYS = "key_id long, account_id int, name string, key_text string, priority int, monthly_quota long, " \
       "remaining_credits long, used_credits long, last_checked string, disabled boolean"


def _keys(spark, rows):
    return spark.createDataFrame(rows, KEYS)


def test_rank_strategies_and_ties(spark):
    k = _keys(spark, [
        (1, 0, "a", "k-aaaaaaaa1", 2, 100, None, 0, "2024-01-02", False),
        (2, 0, "b", "k-aaaaaaaa2", 1, None, None, 0, "", False),  # unknown remaining: +inf first
        (3, 0, "c", "k-aaaaaaaa3", 1, 100, None, 0, "2024-01-01", False),
        (4, 0, "d", "k-aaaaaaaa4", 1, 100, None, 0, None, False),
    ])
    qf = {r.key_id: r.rank for r in pool.rank_keys(k, "quota-first").collect()}
    assert qf == {2: 1, 3: 2, 4: 3, 1: 4}
    rr = {r.key_id: r.rank for r in pool.rank_keys(k, "round-robin").collect()}
    assert rr == {2: 1, 4: 2, 3: 3, 1: 4}  # never used ('' or missing) first, ties by input order
    unknown = {r.key_id: r.rank for r in pool.rank_keys(k, "bogus").collect()}
    assert unknown == {1: 1, 2: 2, 3: 3, 4: 4}


def test_select_key_skips_exhausted_and_wraps(spark):
    k = _keys(spark, [
        (1, 0, "a", "x1", 1, 100, 0, 0, "", False),  # remaining 0 -> exhausted
        (2, 0, "b", "x2", 2, 100, None, 100, "", False),  # used >= quota -> exhausted
        (3, 0, "c", "x3", 3, 0, None, 999, "", False),  # quota 0 means no quota
        (4, 1, "d", "x4", 1, 10, 0, 0, "", False),  # pool 1: all exhausted
    ])
    ranked = pool.rank_keys(k, "priority")
    got = {r.account_id: r.selected_key_id for r in pool.select_key(ranked).collect()}
    assert got == {0: 3, 1: None}
    got = {r.account_id: r.selected_key_id for r in pool.select_key(ranked, auto_disable=False).collect()}
    assert got[0] == 1 and got[1] == 4


def test_next_key_ring_and_single_key_pool(spark):
    k = _keys(spark, [
        (1, 0, "a", "x1", 1, None, None, 0, "", False), (2, 0, "b", "x2", 2, None, None, 0, "", False),
        (3, 1, "c", "x3", 1, None, None, 0, "", False),
    ])
    got = {r.key_id: r.next_key_id for r in pool.next_key(pool.rank_keys(k, "priority")).collect()}
    assert got == {1: 2, 2: 1, 3: None}


def test_resolve_attempts_outcomes(spark):
    a = spark.createDataFrame([
        (1, 1, 0, 200, "ok"), (2, 1, 0, 429, "limit"), (2, 2, 1, 200, "ok"), (3, 1, 0, 429, "limit"),
        (3, 2, 1, 500, "x"), (4, 1, 0, 429, "limit"), (5, 1, 0, 404, "nf"),
    ], "request_id int, attempt int, key_id int, http_status int, body string")
    got = {r.request_id: (r.outcome, r.served_key_id) for r in pool.resolve_attempts(a).collect()}
    assert got == {1: ("ok", 0), 2: ("ok_after_rotation", 1), 3: ("failed_after_rotation", None),
                   4: ("failed_429", None), 5: ("failed", None)}


def test_mask_keys(spark):
    k = _keys(spark, [(1, 0, "main", "wk-1234567890abcdef", 1, None, None, 0, "", False)])
    assert pool.mask_keys(k).first().masked == "main: wk-12345...cdef (priority: 1, quota: auto)"


def test_refresh_quota_rules(spark):
    usage = spark.createDataFrame([("h1", 10, 5, 100), ("h2", 7, None, None)],
                                  "key_hash string, used_credits long, remaining_credits long, plan_credits long")
    feed = spark.createDataFrame([("h1", 30, 100, None), ("h2", 3, 0, None), ("h3", None, 50, None),
                                  ("h1", 1, 1, "HTTP 500")],
                                 "key_hash string, remaining_credits long, plan_credits long, error string")
    got = {r.key_hash: r for r in pool.refresh_quota(usage, feed).collect()}
    assert got["h1"].used_credits == 70  # plan - remaining
    assert got["h2"].used_credits == 7  # zero plan keeps old used
    assert got["h3"].used_credits == 50  # missing remaining counts as 0


def test_allocation_never_exceeds_capacity_and_covers_demand(spark):
    demand = spark.createDataFrame(
        [Row(request_id=i, pool=0, credits=c, light_rank=0, ts=i)
         for i, c in enumerate([3, 5, 2, 8, 1, 9, 4, 4, 7, 6])]
    )
    keys = _keys(spark, [
        (1, 0, "a", "x1", 1, None, 10, 0, "", False), (2, 0, "b", "x2", 1, 20, None, 5, "", False),
        (3, 0, "c", "x3", 1, None, 6, 0, "", False),
    ])
    out = pool.allocate_budget(demand, keys, ["light_rank", "ts"], {"_light": F.col("light_rank"), "_t": F.floor(F.col("ts") / 2)}).collect()
    per_key = {}
    for r in out:
        per_key[r.key_id] = per_key.get(r.key_id, 0) + r.allocated
    assert per_key[3] <= 6 and per_key[1] <= 10 and per_key[2] <= 15
    assert sum(per_key.values()) == 49
    assert per_key[None] == 49 - 31  # overflow beyond every key stays unallocated


def test_skew_safe_ranking_equals_the_window(spark, sf):
    from webledger.sources.fixtures import Views

    keys = pool.eligible_keys(Views(spark, sf).keys)
    for strategy in pool.STRATEGIES + ("unknown",):
        a = {r.key_id: r.rank for r in pool.rank_keys(keys, strategy).collect()}
        b = {r.key_id: r.rank for r in pool.rank_keys(keys, strategy, skew_safe=True).collect()}
        assert a == b, strategy


def test_fallback_key_rules(spark):
    k = _keys(spark, [
        (1, 0, "a", "wk-aaaa", 1, None, None, 0, "", False),
        (2, 1, "b", "wk-bbbb", 1, None, None, 0, "", True),   # disabled
    ])
    fb = spark.createDataFrame([(0, "wk-aaaa"), (1, "wk-bbbb"), (2, "wk-cccc")], "account_id int, key_text string")
    got = {(r.account_id, r.key_text): (r.name, r.priority, r.matches_disabled) for r in pool.add_fallback_key(k, fb).collect()}
    assert (0, "wk-aaaa") in got and got[(0, "wk-aaaa")][0] == "a"      # already eligible: not added
    assert got[(1, "wk-bbbb")] == ("env-default", 999, True)             # equal to a disabled key: re-added, flagged
    assert got[(2, "wk-cccc")] == ("env-default", 999, False)


def test_insert_new_keys_rules(spark):
    k = _keys(spark, [(1, 0, "key-3", "wk-old", 1, None, None, 0, "", False),
                      (2, 0, "x", "wk-x", 2, None, None, 0, "", False)])
    cands = spark.createDataFrame([(10, 0, "wk-new", 700), (11, 0, "wk-old", 5), (12, 0, "wk-new", 9),
                                   (13, 0, "wk-two", None)],
                                  "candidate_id long, account_id int, key_text string, plan_credits long")
    got = {r.candidate_id: (r.name, r.priority, r.monthly_quota) for r in pool.insert_new_keys(k, cands).collect()}
    # duplicates (existing text, or repeated in the batch) are rejected; names continue after key-3
    assert got == {10: ("key-4", 3, 700), 13: ("key-5", 4, 1000)}


def test_mark_exhausted_needs_a_rotation_and_a_usage_row(spark):
    k = _keys(spark, [(1, 0, "a", "x1", 1, None, 50, 0, "", False), (2, 0, "b", "x2", 1, None, 50, 0, "", False),
                      (3, 0, "c", "x3", 1, None, 50, None, "", False)])
    a = spark.createDataFrame([
        (1, 1, 1, 429, "Monthly usage limit reached"), (1, 2, 2, 200, "ok"),   # rotated: key 1 exhausted
        (2, 1, 2, 429, "quota exceeded"),                                      # no rotation: unchanged
        (3, 1, 3, 429, "Quota Exceeded"), (3, 2, 1, 200, "ok"),                # no usage row: unchanged
    ], "request_id int, attempt int, key_id long, http_status int, body string")
    got = {r.key_id: (r.remaining_credits, r.marked_exhausted) for r in pool.mark_exhausted(k, a).collect()}
    assert got == {1: (0, True), 2: (50, False), 3: (50, False)}


def test_remove_keys_takes_the_first_of_a_repeated_name(spark):
    k = _keys(spark, [(1, 0, "dup", "x1", 1, None, None, 0, "", False), (2, 0, "dup", "x2", 1, None, None, 0, "", False),
                      (3, 0, "solo", "x3", 1, None, None, 0, "", False)])
    names = spark.createDataFrame([(0, "dup"), (0, "dup"), (0, "ghost")], "account_id int, name string")
    remaining, not_found = pool.remove_keys(k, names)
    assert sorted(r.key_id for r in remaining.collect()) == [2, 3]
    assert [(r.account_id, r.name) for r in not_found.collect()] == [(0, "ghost")]
