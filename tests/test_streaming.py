"""Streaming twins: the same rows as one batch and as many micro-batches."""

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from webledger.operators import cost, monitor
from webledger.operators.discover import crawl_status
from webledger.operators.replay import replay_cache
from webledger.sources.fixtures import Views
from webledger.streaming import jobs as J


def _split_files(df, path, by, n):
    """Write ``df`` as ``n`` Parquet files ordered by ``by`` (one per trigger)."""
    bounds = df.approxQuantile(by, [i / n for i in range(1, n)], 0.0) if n > 1 else []
    lo = None
    for i, hi in enumerate(bounds + [None]):
        part = df
        if lo is not None:
            part = part.where(F.col(by) > lo)
        if hi is not None:
            part = part.where(F.col(by) <= hi)
        part.coalesce(1).write.mode("overwrite").parquet(f"{path}/f{i:03d}")
        lo = hi


def _drain(stream_df, mode, key, spark, tmp, name):
    latest = {}

    def keep(batch, _):
        for r in batch.collect():
            latest[tuple(r[k] for k in key)] = r.asDict()

    q = (stream_df.writeStream.outputMode(mode).foreachBatch(keep)
         .option("checkpointLocation", f"{tmp}/ckpt-{name}").start())
    q.processAllAvailable()
    q.stop()
    return latest


def _requests(spark, sf):
    r = Views(spark, sf).requests
    return r.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def test_spend_windows_stream_equals_batch_and_drops_late_rows(spark, sf, tmp):
    priced = cost.priced_requests(_requests(spark, sf)).select("request_id", "ts", "account_id", "estimated_credits", "us")
    _split_files(priced, f"{tmp}/in", "us", 4)
    late = priced.orderBy("ts").limit(1).withColumn("request_id", F.lit(-1))
    late.coalesce(1).write.parquet(f"{tmp}/in/f999")  # an early row arriving last
    stream = J.read_request_stream(spark, f"{tmp}/in/*", priced.schema, max_files_per_trigger=1)
    s = J.spend_windows(J.event_time(stream), "1 day", watermark="1 hour")
    got = _drain(s, "update", ["window_start", "account_id"], spark, tmp, "t1")
    want = {(r.window_start, r.account_id): r.credits
            for r in J.spend_windows(J.event_time(priced), "1 day").collect()}
    assert {k: v["credits"] for k, v in got.items()} == want


def test_interact_sessions_stream_equals_batch(spark, sf, tmp):
    r = _requests(spark, sf).select("request_id", "ts", "account_id", "tool", "us")
    _split_files(r, f"{tmp}/in", "us", 3)
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in/*")
    s = J.interact_sessions(J.event_time(stream), 600, 3600, watermark="2 hours")
    got = _drain(s, "append", ["account_id", "session_start"], spark, tmp, "t2")
    # Append mode emits a session once the watermark passes its end; the
    # ones still open at the end of the input are not out yet.
    last_file_start = r.approxQuantile("us", [2 / 3], 0.0)[0]
    closed_by = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=last_file_start) - dt.timedelta(hours=2)
    batch = {(x.account_id, x.session_start): x for x in J.interact_sessions(J.event_time(r), 600, 3600).collect()}
    streamed = {k: v["credits"] for k, v in got.items()}
    assert all(batch[k].credits == c for k, c in streamed.items())
    assert {k for k, x in batch.items() if x.session_end <= closed_by} <= set(streamed)
    assert len(streamed) > 0.6 * len(batch)


END = dt.datetime(2100, 1, 1)


def test_stream_cache_equals_batch_replay(spark, sf, tmp):
    """In batches whose rows are out of time order within the watermark."""
    v = Views(spark, sf)
    pages = v.table("pages").select("page_id", "url")
    log = cost.priced_requests(v.requests).join(pages, "page_id").select(
        "request_id", "url", "format", "ts", "tool", F.col("estimated_credits").alias("credits"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("order_us"))
    end = {"request_id": -1, "url": "", "ts": END, "credits": 0}
    got = J.run_over(log, tmp, lambda s: J.stream_cache(s, watermark="40 days"), order="order_us", slices=4, shuffled=True, end=end)
    want = {r.request_id: (r.hit, r.reason) for r in replay_cache(log.drop("order_us")).collect()}
    assert {r.request_id: (r.hit, r.reason) for r in got.collect()} == want


def test_stream_changes_equals_diff(spark, sf, tmp):
    """First captures that arrive after the second ones are compared in their place."""
    v = Views(spark, sf)
    caps = v.capture_v1.withColumn("capture", F.lit(1).cast("long")).unionByName(
        v.capture_v2.withColumn("capture", F.lit(2).cast("long")))
    caps = caps.withColumn("ts", F.timestamp_seconds(F.col("capture") * 86_400).cast("timestamp_ntz"))
    caps = caps.withColumn("arrives", F.pmod(F.xxhash64("url", "capture"), F.lit(3)))
    got = J.run_over(caps, tmp, lambda s: J.stream_changes(s, "3 days"), order="arrives", end={"url": "", "capture": 3, "ts": END})
    second = {r.url: r.status for r in got.collect() if r.capture == 2}
    diff = {r.url: r.status for r in monitor.diff_captures(v.capture_v1, v.capture_v2).collect()
            if r.status in ("new", "changed")}
    assert second == diff


def test_stream_sessions_end_by_timer_in_time_order(spark, tmp):
    t0 = dt.datetime(2024, 1, 1)
    at = [(1, 0), (1, 200), (1, 900), (1, 1700), (1, 5000), (2, 100), (2, 3699), (2, 3700), (2, 9000)]
    rows = [(i, a, "interact", t0 + dt.timedelta(seconds=s), (i * 7) % 3) for i, (a, s) in enumerate(at)] + [(99, 1, "scrape", t0, 0)]
    df = spark.createDataFrame(rows, "request_id long, account_id long, tool string, ts timestamp_ntz, arrives long")
    end = {"request_id": -1, "account_id": -1, "tool": "interact", "ts": END}
    want = {tuple(r) for r in J.interact_sessions(df, 3600, 1800).collect()}
    for i, order in enumerate(("arrives", "request_id")):
        got = J.run_over(df, f"{tmp}/{i}", lambda s: J.stream_sessions(s, 3600, 1800, "1 day"), order=order, end=end).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) > 4


def test_events_wait_until_the_watermark_has_passed_them(spark, tmp):
    """What comes later than the watermark allows is dropped; what is within its delay is not out yet."""
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [("u", "a", 1, day(1), 0), ("u", "b", 2, day(5), 0), ("u", "b", 3, day(20), 1), ("u", "x", 4, day(2), 2), ("u", "c", 5, day(21), 2)]
    df = spark.createDataFrame(rows, "url string, html string, capture long, ts timestamp_ntz, arrives long")
    got = J.run_over(df, tmp, lambda s: J.stream_changes(s, "3 days"), order="arrives").collect()
    assert {(r.capture, r.status) for r in got} == {(1, "new"), (2, "changed")}


def test_crawl_progress_and_exhaustion_streams(spark, sf, tmp):
    v = Views(spark, sf)
    jp = v.job_pages
    jp.repartition(3).write.parquet(f"{tmp}/jp")
    stream = spark.readStream.schema(jp.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/jp")
    got = _drain(J.stream_crawl_progress(stream), "update", ["job_id"], spark, tmp, "t6")
    want = {r.job_id: (r.completed, r.total) for r in crawl_status(v.jobs, jp).where("total > 0").collect()}
    assert {k[0]: (x["completed"], x["total"]) for k, x in got.items()} == want
    at = v.attempts
    at.repartition(2).write.parquet(f"{tmp}/at")
    s2 = spark.readStream.schema(at.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/at")
    got = _drain(J.stream_exhaustion(s2), "update", ["key_id"], spark, tmp, "t5")
    want = {r.key_id: r.exhausted for r in J.stream_exhaustion(at).collect()}
    assert {k[0]: x["exhausted"] for k, x in got.items()} == want


def test_dedupe_and_match_streams(spark, sf, tmp):
    r = _requests(spark, sf).select("request_id", "ts", "page_id", "format", "http_status", "us")
    _split_files(r, f"{tmp}/in", "us", 3)
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in/*")
    got = _drain(J.dedupe_stream(J.event_time(stream), ["page_id", "format"]), "append", ["request_id"], spark, tmp,
                 "t7")
    assert 0 < len(got) < r.count()
    resp = J.responses_of(r)
    resp.coalesce(1).write.parquet(f"{tmp}/resp")
    rs = spark.readStream.schema(resp.schema).parquet(f"{tmp}/resp")
    m = J.match_responses(J.event_time(stream), J.event_time(rs), 60, watermark="1 minute")
    q = m.writeStream.format("memory").queryName("t8").option("checkpointLocation", f"{tmp}/ck8").start()
    q.processAllAvailable()
    q.stop()
    matched = spark.sql("select count(*) from t8 where not lost").first()[0]
    want = J.match_responses(r, resp, 60).where("not lost").count()
    assert matched == want


def test_write_alerts_foreach_batch(spark, sf, tmp):
    ev = spark.createDataFrame([(1, "monitor.page", "u"), (1, "monitor.check.completed", "c"),
                                (2, "monitor.page", "v")], "monitor_id long, event string, ref string")
    ev.coalesce(1).write.parquet(f"{tmp}/ev")
    subs = spark.createDataFrame([(1, ["monitor.page"]), (2, ["monitor.check.completed"])],
                                 "monitor_id long, events array<string>")
    stream = spark.readStream.schema(ev.schema).parquet(f"{tmp}/ev")
    q = J.write_alerts(stream, subs, f"{tmp}/out", f"{tmp}/ck-s7")
    q.processAllAvailable()
    q.stop()
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert [(r.monitor_id, r.event) for r in rows] == [(1, "monitor.page")]


def test_event_time_cast(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    assert dict(J.event_time(df).dtypes)["ts"] == "timestamp"


def test_stream_cache_forgets_idle_urls(spark, tmp):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, "u", "markdown", t0, "scrape", 1), (2, "v", "markdown", t0, "scrape", 1),
            (3, "v", "markdown", t0 + dt.timedelta(hours=40), "scrape", 1), (4, "v", "markdown", t0 + dt.timedelta(days=3), "scrape", 1),
            (5, "u", "markdown", t0 + dt.timedelta(days=3, hours=1), "scrape", 1)]
    df = spark.createDataFrame(rows, "request_id long, url string, format string, ts timestamp_ntz, tool string, credits long")
    end = {"request_id": -1, "url": "", "ts": END, "credits": 0}
    for hours, of_u in ((48, "URL not cached"), (1440, "Cache expired")):
        got = J.run_over(df, f"{tmp}/{hours}", lambda s, h=hours: J.stream_cache(s, forget_after_hours=h), order="request_id", slices=5, end=end)
        reasons = {r.request_id: r.reason for r in got.collect()}
        assert reasons[3] == reasons[4] == "Cache expired"  # v was seen again before being forgotten
        assert reasons[5] == of_u


_PLAIN_SESSION = """
import datetime as dt, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from webledger.streaming import jobs as J

to = sys.argv[2]
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": f"{to}/kept", "spark.local.dir": f"{to}/local", "spark.driver.host": "127.0.0.1"}).getOrCreate()
at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
far = dt.datetime(2100, 1, 1)
rows = [(1, 1, "interact", at(0)), (2, 1, "interact", at(5)), (3, 1, "interact", at(200)), (4, 2, "scrape", at(0)),
        (5, None, "interact", at(0)), (6, 1, "interact", None)]
asked = spark.createDataFrame(rows, "request_id long, account_id long, tool string, ts timestamp_ntz")
end = {"request_id": -1, "account_id": -1, "tool": "interact", "ts": far}
got = J.run_over(asked, f"{to}/t2", lambda s: J.stream_sessions(s, 3600, 1800, "1 day"), end=end).collect()
assert {(r.account_id, r.n_events) for r in got} == {(1, 1), (1, 2), (None, 1)} and len(got) == 3, got
log = spark.createDataFrame([(i, "u", "markdown", at(i), "scrape", None if i == 2 else 1) for i in (1, 2)],
                            "request_id long, url string, format string, ts timestamp_ntz, tool string, credits long")
end = {"request_id": -1, "url": "", "format": "markdown", "ts": far, "tool": "scrape", "credits": 0}
got = J.run_over(log, f"{to}/t3", lambda s: J.stream_cache(s, watermark="1 day"), end=end).collect()
assert sorted((r.request_id, r.hit) for r in got) == [(1, False), (2, True)], got
caps = spark.createDataFrame([("u", str(c), c, at(c)) for c in (1, 2)], "url string, html string, capture long, ts timestamp_ntz")
end = {"url": "", "html": "", "capture": 3, "ts": far}
got = J.run_over(caps, f"{to}/t4", lambda s: J.stream_changes(s, "1 day"), end=end).collect()
assert sorted((r.capture, r.status) for r in got) == [(1, "new"), (2, "changed")], got
"""


def test_stateful_streams_run_in_a_session_with_spark_defaults(tmp_path):
    """Spark's default state store, and Python workers that can't import this package by name."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = str(Path(__file__).resolve().parents[1])
    ran = subprocess.run([sys.executable, "-c", _PLAIN_SESSION, repo, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]


def test_processor_sends_frames_and_writes_state_only_when_there_is_something_new():
    """Each frame is a batch to send, and each call on a state a message, for every key."""
    import pandas as pd

    class Kept:
        def __init__(self, value):
            self.value, self.calls = value, []

        def get(self):
            self.calls.append("get")
            return iter(self.value) if isinstance(self.value, list) else self.value

        def __getattr__(self, name):
            return lambda *args: self.calls.append(name)

    class Now:
        getCurrentWatermarkInMs = staticmethod(lambda: 5)

    p = J.InOrder(["us", "request_id"], "", "", lambda s, e: ((e[0], e[1]), [(e[1],)]), lambda s: 10**9, lambda s: [], ["url", "request_id"])
    p.waiting, p.state, p.handle = Kept([]), Kept((1, 7)), Kept(None)
    assert list(p.handleInputRows(("u",), iter([pd.DataFrame({"us": [9_000], "request_id": [3]})]), Now)) == []
    assert p.waiting.calls == ["appendList"] and p.handle.calls == ["registerTimer"]
    p.waiting = Kept([(9_000, 3)])
    assert list(p.handleExpiredTimer(("u",), Now, None)) == []
    assert p.state.calls == ["get"] and p.waiting.calls == ["get"]
    p.waiting = Kept([(4_000, 2), (9_000, 3)])
    (frame,) = p.handleExpiredTimer(("u",), Now, None)
    assert frame.values.tolist() == [["u", 2]]
    assert p.waiting.calls == ["get", "put"] and p.state.calls == ["get", "get", "update"]
