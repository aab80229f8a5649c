"""Properties from the test strategy: partitions, minimal depth, replay."""

import datetime as dt
from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webledger.operators import discover as D
from webledger.operators import monitor as M
from webledger.operators import search as S
from webledger.operators.replay import replay_cache
from webledger.sources.fixtures import Views


def test_diff_classes_partition_the_url_union(spark, sf):
    v = Views(spark, sf)
    out = M.diff_captures(v.capture_v1, v.capture_v2).collect()
    urls = [r.url for r in out]
    union = {r.url for r in v.capture_v1.select("url").union(v.capture_v2.select("url")).collect()}
    assert len(urls) == len(set(urls)) == len(union)
    assert {r.status for r in out} <= {"new", "removed", "changed", "same"}


def test_crawl_depth_is_minimal(spark, sf):
    v = Views(spark, sf)
    edges = [(r.src, r.dst) for r in v.link_edges.collect()]
    pages = v.table("pages").collect()
    seeds = {p.page_id for p in pages if p.url.split("://", 1)[1].startswith("blog.")}
    adj: dict[int, list[int]] = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    depth = {s: 0 for s in seeds}
    q = deque(seeds)
    while q:
        n = q.popleft()
        if depth[n] == 3:
            continue
        for m in adj.get(n, []):
            if m not in depth:
                depth[m] = depth[n] + 1
                q.append(m)
    seeds_df = spark.createDataFrame([(s,) for s in seeds], "node long")
    got = {r.node: r.depth for r in D.crawl(v.link_edges, seeds_df, max_depth=3).collect()}
    assert got == depth


T0 = dt.datetime(2024, 1, 1)
events = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.sampled_from(["markdown", "json"]),
              st.integers(min_value=0, max_value=5 * 24 * 60)),
    min_size=1, max_size=60,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events)
def test_replay_equals_sequential_fold(spark, evs):
    rows = [(i, u, f, T0 + dt.timedelta(minutes=m), "scrape", 1) for i, (u, f, m) in enumerate(evs)]
    # put some requests exactly on the 24 h boundary of an earlier one
    rows += [(1000 + i, r[1], r[2], r[3] + dt.timedelta(hours=24), "scrape", 1) for i, r in enumerate(rows[:3])]
    df = spark.createDataFrame(rows, "request_id long, url string, format string, ts timestamp_ntz, tool string, credits long")
    got = {r.request_id: r.hit for r in replay_cache(df).collect()}
    want, entry = {}, {}
    for rid, url, fmt, ts, _, _ in sorted(rows, key=lambda r: (r[1], r[3], r[0])):
        e = entry.get(url)
        hit = e is not None and ts - e[1] <= dt.timedelta(hours=24) and e[0] == fmt
        if not hit:
            entry[url] = (fmt, ts)
        want[rid] = hit
    assert got == want
    assert sum(got.values()) + sum(not h for h in got.values()) == len(rows)


def test_missed_checks_tolerance_is_inclusive(spark):
    slots = spark.createDataFrame([(1, T0), (1, T0 + dt.timedelta(hours=1)), (2, T0)],
                                  "monitor_id long, slot_ts timestamp_ntz")
    checks = spark.createDataFrame([(1, T0 + dt.timedelta(minutes=30)), (2, T0 + dt.timedelta(minutes=31))],
                                   "monitor_id long, checked_at timestamp_ntz")
    missed = sorted((r.monitor_id, r.slot_ts) for r in M.missed_checks(slots, checks, 30).collect())
    assert missed == [(2, T0)]  # 30 minutes away still counts, 31 does not
    on_time = checks.unionByName(spark.createDataFrame([(2, T0)], "monitor_id long, checked_at timestamp_ntz"))
    assert [r.monitor_id for r in M.missed_checks(slots, on_time, 0).collect() if r.slot_ts == T0] == [1]


def test_target_validity_and_too_many_recipients(spark):
    targets = spark.createDataFrame([
        (1, None, [("search", None, None, ["q"])]),
        (2, "g", [("scrape", ["u1", "u2"], None, None)]),
        (3, "g", []), (4, "g", None), (5, "g", [("scrape", [], None, None)]), (6, "g", [("crawl", None, None, None)]),
    ], "monitor_id long, goal string, "
       "targets array<struct<type:string, urls:array<string>, url:string, queries:array<string>>>")
    got = {(r.monitor_id, r.unit, r.valid) for r in M.expand_targets(targets).collect()}
    # A search needs a goal; monitors and targets with nothing to do stay and aren't valid.
    assert got == {(1, "q", False), (2, "u1", True), (2, "u2", True), *((m, None, False) for m in (3, 4, 5, 6))}
    changes = spark.createDataFrame([("u1", "changed")], "url string, status string")
    units = spark.createDataFrame([(2, "u1"), (3, "u1")], "monitor_id long, unit string")
    notify = spark.createDataFrame([(2, True, [f"r{i}" for i in range(30)]), (3, False, ["x"])],
                                   "monitor_id long, enabled boolean, recipients array<string>")
    out = M.fan_out_alerts(changes, units, notify).collect()
    assert len(out) == 30 and {(r.monitor_id, r.valid) for r in out} == {(2, False)}


def test_recipients_are_not_sent_to_all_tasks(spark):
    changes = spark.createDataFrame([("u1", "changed")], "url string, status string")
    units = spark.createDataFrame([(2, "u1"), (4, "u1")], "monitor_id long, unit string")
    notify = spark.createDataFrame([(2, True, ["a", "b"], True), (4, True, [], False)],
                                   "monitor_id long, enabled boolean, recipients array<string>, include_diffs boolean")
    diffs = spark.createDataFrame([("u1", "added", "x"), ("u1", "removed", "y")], "url string, kind string, line string")
    out = M.fan_out_alerts(changes, units, notify, diffs)
    assert out.columns == ["url", "monitor_id", "status", "valid", "recipient", "diff"]
    assert {(r.monitor_id, *r[3:]) for r in out.collect()} == {(2, True, "a", "+x\n-y"), (2, True, "b", "+x\n-y"), (4, False, None, None)}
    sent = out._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in sent.splitlines() if "Join [monitor_id" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
    assert "explode(recipients" in sent.split("Join [monitor_id")[0]  # unfolded above the join


def test_versions_of_a_corpus_are_searched_as_if_alone(spark):
    rows = [(1, "red fox and red hen", True), (2, "blue fox", True), (2, "two foxes", False), (3, "red", False), (4, None, True), (5, "", True), (None, "hen fox", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, before boolean")
    queries = spark.createDataFrame([(1, "red fox"), (2, "hen"), (3, "none of two")], "query_id long, query string")
    found = S.search_versions(docs, {"before": F.col("before"), "now": F.lit(True), "never": F.lit(False)}, queries, limit=2)
    got = {tuple(r) for r in found.select("version", "query_id", "doc_id", "score", "rank").collect()}
    for version, part in (("before", docs.where("before")), ("now", docs), ("never", docs.where("false"))):
        alone = S.search(part, queries, limit=2).select("query_id", "doc_id", "score", "rank").collect()
        assert {r[1:] for r in got if r[0] == version} == {tuple(r) for r in alone}


def test_relevant_changes_in_cells_equal_brute_force(spark, monkeypatch):
    import math
    import random
    import re
    from collections import defaultdict

    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n)) + "; common"
    changes = [(f"u{i % 90}", rng.choice(["added", "added", "removed"]), text(rng.randint(0, 4))) for i in range(200)] + [(None, "added", "w1 w2")]
    goals = [(rng.randint(0, 150), text(rng.randint(0, 9)).upper()) for _ in range(300)] + [(7, None), (None, "w1 w3"), (None, "w4 w4")]
    terms = lambda t: {x for x in re.split(r"[^a-z0-9]+", (t or "").lower()) if x}
    held, asked, df = defaultdict(set), defaultdict(set), defaultdict(int)
    for u, kind, line in changes:
        held[u] |= terms(line) if kind == "added" else set()
    for g, goal in goals:
        asked[g] |= terms(goal)
    held = {u: t for u, t in held.items() if t}
    for t in held.values():
        for x in t:
            df[x] += 1
    n = len(held.keys() - {None})
    want = set()
    for u, t in held.items():
        scores = []
        for g, a in asked.items():
            both = [x for x in t & a if df[x] <= max(2.0, n * 0.05)]
            if both:
                scores.append((-round(sum(math.log(n / df[x]) for x in both), 6), -1 if g is None else g, g))
        want |= {(u, g, -s, p) for p, (s, _, g) in enumerate(sorted(scores)[:3], 1)}
    assert len(want) > 100
    d = spark.createDataFrame(changes, "url string, kind string, line string")
    g = spark.createDataFrame(goals, "goal_id long, goal string")
    for sizes in ((100_000, 50_000, 1 << 21), (20, 40, 7)):
        for name, value in zip(("CHANGES", "GOALS", "PAIRS"), sizes, strict=True):
            monkeypatch.setattr(M, name, value)
        got = {(r.url, r.goal_id, r.score, r.place) for r in M.relevant_changes(d, g, common_share=0.05).collect()}
        assert got == want
    alone = spark.createDataFrame([("u", "added", "w1")], d.schema)
    assert [tuple(r) for r in M.relevant_changes(alone, g.where("goal = 'w1 w3'")).collect()] == [("u", None, 0.0, 1)]
    assert M.relevant_changes(d.limit(0), g).count() == 0 and M.relevant_changes(d, g.limit(0)).count() == 0


def test_relevant_changes_never_shuffle_pairs(spark):
    """The pairs of changes and goals, here 40,000, stay inside the cells of the grid."""
    d = spark.range(400).selectExpr("concat('u', id) as url", "'added' as kind", "concat('t', id % 200) as line")
    g = spark.range(20_000).selectExpr("id as goal_id", "concat('t', id % 200) as goal")
    out = M.relevant_changes(d, g)
    assert out.count() == 1200
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "goal_id" not in "".join(x for x in plan.splitlines() if "HashAggregate" in x)
