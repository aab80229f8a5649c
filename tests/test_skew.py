"""A key holding a third of the rows is spread, not gathered in one task."""

import contextlib
import datetime as dt
import io
import random

from pyspark.sql import functions as F

from webledger.operators import discover as D
from webledger.operators.windows import prefix_scan
from webledger.streaming import jobs as J


def _hot_log(spark, n=30000):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"u{rnd.randint(0, 500)}", rnd.randint(0, 30 * 86_400_000_000))
            for i in range(n)]
    return spark.createDataFrame(rows, "request_id long, url string, us long")


def test_prefix_scan_spreads_a_hot_key(spark):
    df = _hot_log(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (df.orderBy("url", "us", "request_id").withColumn("p", F.spark_partition_id())
                 .groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url") == "hot").alias("hot"))
                 .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r.n for r in parts]
    assert sum(1 for r in parts if r.hot > 0) >= 2  # the hot URL spans several tasks
    assert max(sizes) <= 2.5 * (sum(sizes) / len(sizes))
    # and the scan itself stays exact
    idx = prefix_scan(df, ["url", "us", "request_id"], {"i": ("sum", F.lit(1))})
    got = sorted(r.i for r in idx.select("i").collect())
    assert got == list(range(1, df.count() + 1))


def test_session_scan_equals_session_window_on_a_hot_account(spark):
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 3 == 0 else rnd.randint(1, 40), "interact", t0 + dt.timedelta(seconds=rnd.randint(0, 86400 * 3)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "request_id long, account_id long, tool string, ts timestamp_ntz")
    a = {(r.account_id, r.session_start): (r.n_events, r.credits) for r in J.interact_sessions(df, 600, 3600).collect()}
    b = {(r.account_id, r.session_start): (r.n_events, r.credits) for r in J.interact_sessions_scan(df, 600, 3600).collect()}
    assert a == b


def test_running_sum_equals_a_window_on_a_hot_key(spark):
    from pyspark.sql import Window

    from webledger.operators.windows import running_sum

    rnd = random.Random(9)
    rows = [(i, 0 if i % 3 == 0 else rnd.randint(1, 30), rnd.randint(0, 10_000), rnd.randint(1, 9)) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, acct long, t long, v long")
    got = {r.id: r.running for r in running_sum(df, ["acct"], ["t", "id"], "v").collect()}
    w = Window.partitionBy("acct").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.running for r in df.withColumn("running", F.sum("v").over(w)).collect()}
    assert got == want


def _formatted(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def hub_graph(spark):
    """Node 0 holds a third of all edges; the others form chains of ten."""
    chains = spark.range(1, 20_001).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).where("src % 10 <> 0")
    return chains.unionByName(spark.range(9_000).select(F.lit(0).cast("long").alias("src"), (F.col("id") * 2 + 1).alias("dst")))


def test_a_hub_node_of_the_crawl_spans_several_tasks(spark):
    edges = hub_graph(spark).withColumnRenamed("src", "node")
    plain, hubs, hub_edges = D.split_adjacency(edges, 8, hub_edges=100)
    assert [tuple(r) for r in hubs.collect()] == [(0, 90)]
    assert plain.where("node = 0").isEmpty() and plain.count() + hub_edges.count() == edges.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seeds = spark.createDataFrame([(0,)], "node long")
        out = D.hop(seeds, plain, hubs, hub_edges)
        moved = [b for b in _formatted(out).split("\n\n") if ") Exchange" in b and "dst" in b]
        by_task = hub_edges.groupBy(F.pmod(F.hash("node", "piece"), F.lit(8))).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(by_task) == 8 and max(r["count"] for r in by_task) <= 2.5 * 9_000 / 8  # a bucket is a task
    assert not moved  # no edge is shuffled, only what they lead to
    assert out.count() == 9_000


def test_crawl_over_hubs_equals_crawl_without(spark):
    seeds = spark.createDataFrame([(0,), (5,)], "node long")
    for depth in (1, None):
        got = [{tuple(r) for r in D.crawl(hub_graph(spark), seeds, max_depth=depth, hub_edges=h).collect()} for h in (500, 10**6)]
        assert got[0] == got[1] and len(got[0]) > 9_000


def chain_by_segments(us, cuts):
    """The misses by age of one run that starts at time 0, through the segments' maps, in batches cut at ``cuts`` rows."""
    import pyarrow as pa

    from webledger.operators import replay as R

    ttl, width = 24 * 100, 100
    late = sorted(t for t in us if t > ttl)
    rows = sorted(((t // width) % 24, t) for t in late)
    table = pa.table({"url": pa.array(["u"] * len(rows)), "run_us": pa.array([0] * len(rows), pa.int64()),
                      "bin": pa.array([t // width for _, t in rows], pa.int64()), "us": pa.array([t for _, t in rows], pa.int64()),
                      "place": pa.array([p for p, _ in rows], pa.int64())})
    maps = pa.Table.from_batches(list(R.segment_maps(ttl, width)(iter(table.to_batches(max_chunksize=cuts)))))
    maps = maps.sort_by("bin")
    taken = pa.Table.from_batches(list(R.taken_paths(iter(maps.to_batches(max_chunksize=cuts)))))
    got = sorted(t for path in taken["path"].to_pylist() for t in path)
    want, last = [], 0
    for t in sorted(us):
        if t - last > ttl:
            want.append(t)
            last = t
    return got, want


def test_chains_through_segments_equal_a_fold():
    rnd = random.Random(13)
    for n, span in ((3, 10_000), (40, 30_000), (600, 40_000), (4_000, 24_000), (50, 3_000_000)):
        for cuts in (1, 7, 10_000):
            got, want = chain_by_segments([rnd.randint(1, span) for _ in range(n)], cuts)
            assert got == want
    # daily requests at one place of the period, and exactly at a TTL's end
    for step in (2400, 2401, 2399, 1200):
        got, want = chain_by_segments([step * i for i in range(1, 200)], 50)
        assert got == want and len(want) > 50


def test_replay_deals_the_log_once_and_spreads_a_hot_url(spark):
    from webledger.operators import replay as R

    log = _hot_log(spark).select("request_id", "url", F.lit("markdown").alias("format"),
                                 F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), F.lit("scrape").alias("tool"), F.lit(1).alias("credits"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = R.replay_cache(log)
        moved = [b for b in _formatted(out).split("\n\n") if ") Exchange" in b and "request_id" in b]
        assert not moved  # after the bucketed write, bins and misses move, requests don't
        rows = log.withColumn("bin", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (24 * R.HOUR_US // R.SEGMENTS)))
        per_task = [r["count"] for r in rows.where("url = 'hot'").groupBy(F.pmod(F.hash("url", "bin"), F.lit(8)).alias("task")).count().collect()]
        assert len(per_task) == 8 and max(per_task) <= 1.5 * 10_000 / 8
        assert out.count() == log.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_requests_without_url_or_time_miss_and_write_nothing(spark):
    from webledger.operators.replay import replay_cache

    t = dt.datetime(2024, 1, 1)
    rows = [(1, None, t), (2, None, t), (3, "u", None), (4, "u", t), (5, "u", t), (6, "u", None)]
    log = spark.createDataFrame(rows, "request_id long, url string, ts timestamp_ntz").selectExpr(
        "*", "cast(null as string) as format", "'scrape' as tool", "1 as credits")
    got = {r.request_id: (r.hit, r.reason.split(" (")[0]) for r in replay_cache(log).collect()}
    miss = (False, "URL not cached")
    assert got == {1: miss, 2: miss, 3: miss, 4: miss, 6: miss, 5: (True, "Already scraped scrape at 2024-01-01T00:00:00.000Z")}
    assert replay_cache(log.limit(0)).isEmpty()
