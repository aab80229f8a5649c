"""Structured Streaming forms of the operators.

Each stream job has a batch twin with the same output on the same rows;
the tests feed one input as a single batch and as many micro-batches and
compare.  Test data loads as ``TIMESTAMP_NTZ``, which ``withWatermark``
rejects, so streams cast event time to ``timestamp`` (session zone UTC).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from webledger.functions.exprs import epoch_micros
from webledger.operators.cache import ALREADY, EXPIRED, NOT_CACHED, OTHER_FORMAT
from webledger.session import keep_state_in_rocksdb

HOUR_US = 3_600_000_000

# A stateful processor is first run by a Python worker of the driver, which
# does not see files added to the session.  So what this module defines is
# sent whole, not by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_request_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1
                        ) -> DataFrame:
    """An unbounded request log from a folder of Parquet files."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    )


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


# T1 ---------------------------------------------------------------------------


def spend_windows(priced: DataFrame, size: str, slide: str | None = None, watermark: str | None = None,
                  ts: str = "ts") -> DataFrame:
    """Credits and calls per account in tumbling (``slide`` None) or
    sliding event-time windows; in a stream, rows later than the watermark
    are dropped."""
    df = priced
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(w.alias("w"), "account_id")
        .agg(F.sum("estimated_credits").alias("credits"), F.count(F.lit(1)).alias("calls"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "account_id",
                "credits", "calls")
    )


# T2 ---------------------------------------------------------------------------

INTERACT_ACTIVITY_TTL = 300
INTERACT_TTL = 600


def interact_sessions(requests: DataFrame, activity_ttl: int = INTERACT_ACTIVITY_TTL, ttl: int = INTERACT_TTL,
                      watermark: str | None = None, ts: str = "ts") -> DataFrame:
    """Browser sessions per account - a session ends after
    ``activity_ttl`` seconds without activity (10-3600), and ``ttl`` seconds
    (30-3600) after its start at the latest; activity after that starts a new
    one.  Billed ``ceil(seconds / 60) * 2``.

    Activity without a gap is one session window; its times are then cut into
    sessions in order.  An account's stretch of activity is held by one task
    (``interact_sessions_scan`` holds none)."""
    check_ttls(activity_ttl, ttl)
    df = requests.where(F.col("tool") == "interact")
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    runs = df.groupBy(F.session_window(ts, f"{activity_ttl} seconds").alias("s"), "account_id").agg(
        F.array_sort(F.collect_list(epoch_micros(F.col(ts)))).alias("times")
    )
    cut = F.expr(f"""aggregate(times, cast(array() as array<struct<first:bigint,last:bigint,n:bigint>>), (a, t) ->
      if(size(a) = 0 or t >= element_at(a, -1).first + {ttl * 1_000_000},
         concat(a, array(named_struct('first', t, 'last', t, 'n', 1L))),
         concat(slice(a, 1, size(a) - 1),
                array(named_struct('first', element_at(a, -1).first, 'last', t, 'n', element_at(a, -1).n + 1L)))))""")
    each = runs.select("account_id", F.col("s.start").alias("s"), F.element_at("times", 1).alias("t0"), F.explode(cut).alias("x"))
    start = F.col("s") + F.make_dt_interval(secs=((F.col("x.first") - F.col("t0")) / F.lit(1_000_000)).cast("decimal(18,6)"))
    return billed(each.select("account_id", start.alias("session_start"), F.col("x.n").alias("n_events"),
                              (F.col("x.last") - F.col("x.first")).alias("active_us")), activity_ttl, ttl)


def check_ttls(activity_ttl: int, ttl: int) -> None:
    if not (10 <= activity_ttl <= 3600 and 30 <= ttl <= 3600):
        raise ValueError("activityTtl must be 10-3600 and ttl 30-3600 seconds")


def billed(sessions: DataFrame, activity_ttl: int, ttl: int) -> DataFrame:
    """Sessions (account_id, session_start, n_events, active_us) with their end and credits."""
    secs = F.least((F.col("active_us") / F.lit(1_000_000) + activity_ttl).cast("decimal(18,6)"), F.lit(ttl).cast("decimal(18,6)"))
    return sessions.select(
        "account_id", "session_start", (F.col("session_start") + F.make_dt_interval(secs=secs)).alias("session_end"), "n_events",
        F.ceil(secs).cast("bigint").alias("billed_seconds"), (F.ceil(secs / 60) * 2).cast("bigint").alias("credits"),
    )


# Events in time order ------------------------------------------------------------


def plain(values: Iterable) -> list:
    """Values without pandas' forms of null: whole numbers among nulls come as floats, and a null as NaN."""
    return [None if pd.isna(x) else int(x) if isinstance(x, float) else x for x in values]


class InOrder(StatefulProcessor):
    """Events of a key, folded in event-time order whatever batch they come in.

    They wait in a list state until the watermark has passed them; then a
    timer takes those that are due, sorted by time and ``order``, and steps
    through them.  ``step(state, event)`` gives the new state and output rows.
    A state ends by itself at ``deadline(state)`` (microseconds): then, or when
    an event at that time or later is stepped to, ``close(state)`` gives its
    last rows and the state is gone.  So a key holds the events of one
    watermark's delay, and one state until its deadline.
    """

    def __init__(self, columns: list[str], waits: str, state: str, step: Callable, deadline: Callable, close: Callable, out: list[str]) -> None:
        self.columns, self.waits, self.kept = columns, waits, state
        self.step, self.deadline, self.close_state, self.out = step, deadline, close, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waits)
        self.state = handle.getValueState("state", self.kept)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            events = list(zip(*(plain(frame[c].tolist()) for c in self.columns), strict=True))
            if events:
                self.waiting.appendList(events)
                low = min(e[0] for e in events)
                first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())  # a frame, even an empty one, is a batch of its own to send

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted(self.waiting.get(), key=lambda e: e[:2])
        due, later = [e for e in events if e[0] <= now], [e for e in events if e[0] > now]
        kept = self.state.get()
        state = before = None if kept is None else tuple(kept)
        rows = []
        for e in due:
            if state is not None and self.deadline(state) <= e[0]:
                rows += self.close_state(state)
                state = None
            state, more = self.step(state, e)
            rows += more
        if state is not None and self.deadline(state) <= now:
            rows += self.close_state(state)
            state = None
        if due:
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        if state is None:
            if before is not None:
                self.state.clear()
        elif state != before:
            self.state.update(state)
        ends = [t for t in (later[0][0] if later else None, self.deadline(state) if state is not None else None) if t is not None]
        if ends:
            self.handle.registerTimer(min(ends) // 1000 + 1)
        if rows:
            yield pd.DataFrame([(*plain(key), *r) for r in rows], columns=self.out)

    def close(self) -> None:
        pass


def in_order(df: DataFrame, key: str, events: list[str], waits: str, state: str, step: Callable, deadline: Callable, close: Callable, out: str,
             watermark: str) -> DataFrame:
    """``df`` (key, ts, events: time in microseconds first, then what orders equal times) through ``InOrder``;
    a row without a time has no place in the order and is left out."""
    keep_state_in_rocksdb(df.sparkSession)
    names = [field.split()[0] for field in out.split(", ")]
    return df.where(F.col("ts").isNotNull()).withWatermark("ts", watermark).groupBy(key).transformWithStateInPandas(
        InOrder(events, waits, state, step, deadline, close, names), out, "append", "EventTime"
    )


def stream_sessions(requests: DataFrame, activity_ttl: int = INTERACT_ACTIVITY_TTL, ttl: int = INTERACT_TTL, watermark: str = "1 hour") -> DataFrame:
    """T2 on a stream: an account's open session is its state, and a timer ends
    it; no task holds more than that and the activity of one watermark's delay."""
    check_ttls(activity_ttl, ttl)
    gap, longest = activity_ttl * 1_000_000, ttl * 1_000_000
    df = requests.where(F.col("tool") == "interact").select(
        "account_id", F.col("ts").cast("timestamp").alias("ts"), epoch_micros(F.col("ts")).alias("us"), "request_id")

    def step(state, event):
        us = event[0]
        return ((us, us, 1) if state is None else (state[0], us, state[2] + 1)), []

    found = in_order(
        df, "account_id", ["us", "request_id"], "us long, request_id long", "first long, last long, n long", step,
        lambda s: min(s[1] + gap, s[0] + longest), lambda s: [(s[0], s[2], s[1] - s[0])], "account_id long, first long, n_events long, active_us long", watermark,
    )
    start = F.timestamp_micros("first").cast("timestamp_ntz")
    return billed(found.select("account_id", start.alias("session_start"), "n_events", "active_us"), activity_ttl, ttl)


# T3 ---------------------------------------------------------------------------


def _iso(us: int) -> str:
    return pd.Timestamp(us, unit="us").strftime("%Y-%m-%dT%H:%M:%S.") + f"{(us // 1000) % 1000:03d}Z"


def stream_cache(log: DataFrame, ttl_hours: int = 24, forget_after_hours: int = 24 * 60, watermark: str = "1 hour") -> DataFrame:
    """K2 on a stream - per-URL state (format, time, tool, credits), folded
    in event-time order once the watermark has passed a request, so batches
    may come out of order within it.

    An entry is kept after it expires, as the reference's store keeps it: the
    next request then reads "Cache expired".  A URL idle for
    ``forget_after_hours`` (60 days) is dropped by a timer, and its next
    request reads "URL not cached" (both are misses).
    """
    ttl_us, forget_us = ttl_hours * HOUR_US, forget_after_hours * HOUR_US

    def step(entry, event):
        us, rid, fmt, tool, credits = event
        fmt = fmt or "markdown"
        if entry is None:
            hit, why = False, NOT_CACHED
        elif us - entry[1] > ttl_us:
            hit, why = False, EXPIRED
        elif entry[0] != fmt:
            hit, why = False, OTHER_FORMAT % (entry[0], fmt)
        else:
            hit, why = True, ALREADY % (entry[2], _iso(int(entry[1])), int(entry[3]))
        entry = (*entry[:4], us) if hit else (fmt, us, tool, credits, us)
        return entry, [(rid, hit, why)]

    df = log.withColumns({"us": epoch_micros(F.col("ts")), "ts": F.col("ts").cast("timestamp"), "credits": F.col("credits").cast("long")})
    out = in_order(
        df.select("url", "ts", "us", "request_id", "format", "tool", "credits"), "url", ["us", "request_id", "format", "tool", "credits"],
        "us long, request_id long, format string, tool string, credits long", "fmt string, us long, tool string, credits long, seen_us long",
        step, lambda s: s[4] + forget_us, lambda s: [], "url string, request_id long, hit boolean, reason string", watermark,
    )
    return out.select("request_id", "url", "hit", "reason")


# T4 ---------------------------------------------------------------------------


def stream_changes(captures: DataFrame, watermark: str = "1 hour", forget_after_hours: int = 24 * 365) -> DataFrame:
    """T4: emit ``new`` and ``changed`` captures (url, capture, ts, html) by the
    content hash of the URL's capture before it, in the order of ``ts`` and
    ``capture``.  A capture waits until the watermark has passed it, so late
    ones are compared in their place; a URL without captures for
    ``forget_after_hours`` (a year) is forgotten, and is then ``new`` again."""
    forget_us = forget_after_hours * HOUR_US

    def step(last, event):
        us, capture, sha = event
        status = "new" if last is None else "changed" if sha != last[0] else None
        return (sha, us), [] if status is None else [(capture, status)]

    df = captures.select("url", F.col("ts").cast("timestamp").alias("ts"), epoch_micros(F.col("ts")).alias("us"), "capture", F.sha2("html", 256).alias("sha"))
    return in_order(
        df, "url", ["us", "capture", "sha"], "us long, capture long, sha string", "sha string, seen_us long", step,
        lambda s: s[1] + forget_us, lambda s: [], "url string, capture long, status string", watermark,
    )


# T5 ---------------------------------------------------------------------------


def stream_exhaustion(attempts: DataFrame) -> DataFrame:
    """T5: per key - successful calls so far and an exhausted flag once a 429
    body says the monthly limit or quota is spent (update mode)."""
    body = F.lower(F.col("body"))
    limit_hit = (F.col("http_status") == 429) & (body.contains("monthly usage limit") | body.contains("quota exceeded"))
    return attempts.groupBy("key_id").agg(
        F.count_if((F.col("http_status") >= 200) & (F.col("http_status") < 300)).alias("successes"),
        F.count_if(limit_hit).alias("limit_hits"),
        F.max(limit_hit).alias("exhausted"),
    )


def stream_exhaustion_marks(attempts: DataFrame, watermark: str | None = None, within: str = "1 hour") -> DataFrame:
    """T5, the rule of R5: a key whose first try met a spent limit or quota is
    marked when the call rotated, that is, when its retry arrives (a
    stream-stream join; append mode).  One row per such call."""
    body = F.lower(F.col("body"))
    limit_hit = (F.col("http_status") == 429) & (body.contains("monthly usage limit") | body.contains("quota exceeded"))
    first = attempts.where((F.col("attempt") == 1) & limit_hit).select("request_id", "key_id", F.col("ts").alias("first_ts"))
    retry = attempts.where(F.col("attempt") == 2).select(F.col("request_id").alias("retried"), F.col("ts").alias("retry_ts"))
    if watermark is not None:
        first, retry = first.withWatermark("first_ts", watermark), retry.withWatermark("retry_ts", watermark)
    return first.join(
        retry, (F.col("request_id") == F.col("retried")) & (F.col("retry_ts") >= F.col("first_ts"))
        & (F.col("retry_ts") <= F.col("first_ts") + F.expr(f"INTERVAL {within}")),
    ).select("request_id", "key_id")


def quota_exhaustion(usage: DataFrame, keys: DataFrame) -> DataFrame:
    """T5, the rule of quotas: keys whose used credits and successes so far
    (``stream_exhaustion``) reach their monthly quota."""
    k = keys.select("key_id", "monthly_quota", "used_credits")
    used = F.col("used_credits") + F.col("successes")
    return usage.select("key_id", "successes").join(k, "key_id").select(
        "key_id", used.alias("used"),
        F.coalesce((F.col("monthly_quota") != 0) & (used >= F.col("monthly_quota")), F.lit(False)).alias("quota_spent"),
    )


# T6 ---------------------------------------------------------------------------


def stream_crawl_progress(job_pages: DataFrame) -> DataFrame:
    """Completed and total pages per job as pages finish (update mode)."""
    return job_pages.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "completed").alias("completed"),
    )


# T7 ---------------------------------------------------------------------------


def dedupe_stream(requests: DataFrame, keys: list[str], within: str = "24 hours", ts: str = "ts") -> DataFrame:
    """Suppress a repeat of the same keys while the first is inside the
    watermark delay (Spark's own definition, not equal to K2)."""
    return requests.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


# T8 ---------------------------------------------------------------------------


def match_responses(requests: DataFrame, responses: DataFrame, within_seconds: int = 60,
                    watermark: str | None = None) -> DataFrame:
    """Pair each request with its response inside a time bound; a
    request without one comes out with null response fields (lost)."""
    r = requests.select("request_id", F.col("ts").alias("req_ts"))
    s = responses.select(F.col("request_id").alias("resp_request_id"), F.col("ts").alias("resp_ts"), "http_status")
    if watermark is not None:
        r = r.withWatermark("req_ts", watermark)
        s = s.withWatermark("resp_ts", watermark)
    cond = (
        (F.col("request_id") == F.col("resp_request_id"))
        & (F.col("resp_ts") >= F.col("req_ts"))
        & (F.col("resp_ts") <= F.col("req_ts") + F.expr(f"INTERVAL {within_seconds} SECONDS"))
    )
    return r.join(s, cond, "left_outer").select(
        "request_id", "req_ts", "resp_ts", "http_status", F.col("resp_ts").isNull().alias("lost")
    )


def responses_of(requests: DataFrame) -> DataFrame:
    """Responses derived from the request log: arrive ``request_id % 90``
    seconds later; 500s are never answered."""
    return requests.where(F.col("http_status") != 500).select(
        "request_id", (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("request_id") % 90)).alias(
            "ts"), "http_status",
    )


# S7 ---------------------------------------------------------------------------


def write_alerts(events: DataFrame, subscriptions: DataFrame, path: str, checkpoint: str):
    """S7 (stream form): subscribed alert events appended to a Parquet table,
    one idempotent write per micro-batch (the batch id names the folder)."""
    subs = subscriptions.select("monitor_id", F.explode("events").alias("event"))

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.join(subs, ["monitor_id", "event"], "left_semi")
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def interact_sessions_scan(requests: DataFrame, activity_ttl: int = INTERACT_ACTIVITY_TTL, ttl: int = INTERACT_TTL,
                           ts: str = "ts") -> DataFrame:
    """T2, batch form for skewed logs: the same sessions without putting an
    account's history in one task.  Rows get a global index in (account,
    time, id) order; a run starts where the previous row is another account or
    at least ``activity_ttl`` earlier; within a run sessions start as the
    chain of K2's misses does.  Sessions then aggregate partially."""
    from webledger.operators.replay import chain_starts
    from webledger.operators.windows import prefix_scan
    from webledger.session import cut_lineage

    check_ttls(activity_ttl, ttl)
    gap = activity_ttl * 1_000_000
    r = requests.where(F.col("tool") == "interact").select(
        "request_id", "account_id", F.col(ts).alias("ts"), epoch_micros(F.col(ts)).alias("us"))
    r = prefix_scan(r, ["account_id", "us", "request_id"], {"idx": ("sum", F.lit(1))})
    r = cut_lineage(r.withColumn("idx", F.col("idx") - 1))
    prev = r.select((F.col("idx") + 1).alias("idx"), F.col("account_id").alias("p_acc"), F.col("us").alias("p_us"))
    r = r.join(prev, "idx", "left").withColumn(
        "start", F.col("p_acc").isNull() | (F.col("p_acc") != F.col("account_id")) | (F.col("us") - F.col("p_us") >= gap)
    ).drop("p_acc", "p_us")
    r = cut_lineage(prefix_scan(r, ["idx"], {"run": ("sum", F.col("start").cast("bigint"))}))
    starts, r = chain_starts(r, "account_id", ttl * 1_000_000 - 1)  # activity at the very end starts anew
    starts = starts.select(F.col("i").alias("idx"), F.lit(True).alias("begins"))
    r = r.join(starts, "idx", "left")
    r = prefix_scan(r, ["idx"], {"sid": ("max", F.when(F.col("begins"), F.col("idx")))})
    s = r.groupBy("sid").agg(
        F.first("account_id").alias("account_id"), F.min("ts").alias("session_start"), F.count(F.lit(1)).alias("n_events"),
        (F.max("us") - F.min("us")).alias("active_us"),
    )
    return billed(s, activity_ttl, ttl)


# Streams run to their end ------------------------------------------------------


def run_over(df: DataFrame, path: str, build, mode: str = "append", key: list[str] | None = None,
             order: str | None = None, slices: int = 3, shuffled: bool = False, end: dict | None = None) -> DataFrame:
    """The result of the stream ``build(source)`` over the rows of ``df``.

    The rows arrive in ``slices`` steps, cut by ``order`` (a number) if given:
    each step's files are written to the stream's folder, and the stream runs
    over what is new (available now) with one checkpoint throughout.  Results
    go to Parquet folders named by batch; with ``key``, the row of a key's
    last batch counts (update mode).  ``shuffled`` deals the rows of two
    neighbouring steps to both, by a hash.  ``end`` (column: value) is a row later than
    all others, sent twice at last: the first moves the watermark past them,
    and with the second their timers run; what comes of it is not returned, as
    the watermark does not pass it."""
    spark = df.sparkSession
    lo, hi = df.agg(F.min(order), F.max(order)).first() if order else (0, 0)
    result = None
    steps = slices if lo is not None and hi > lo else 1
    last = None if end is None else df.sparkSession.createDataFrame(
        [tuple(end.get(c) for c in df.columns)], T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    for i in range(steps + (0 if last is None else 2)):
        part = df
        if i >= steps:
            part = last
        elif steps > 1:
            at = F.least(F.lit(slices - 1), F.floor((F.col(order) - lo) * slices / (hi - lo + 1)))
            if shuffled:  # pairs of steps share their rows
                at = F.least(F.lit(slices - 1), at - at % 2 + F.pmod(F.xxhash64(*df.columns), F.lit(2)))
            part = df.where(at == i)
        part.write.parquet(f"{path}/in/f{i}")
        stream = build(read_request_stream(spark, f"{path}/in/*", df.schema, max_files_per_trigger=1_000_000))
        if result is None:
            result = T.StructType([*stream.schema.fields, T.StructField("_batch", T.LongType())])
            spark.createDataFrame([], result).write.parquet(f"{path}/out/none")  # a stream without rows has no batch

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/out/b{batch_id}")

        q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint")
        q.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(result).parquet(f"{path}/out/*")
    if key is None:
        return rows.drop("_batch")
    rest = [c for c in result.names if c not in (*key, "_batch")]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_batch").alias("v"))
    return last.select(*key, *[F.col(f"v.{c}").alias(c) for c in rest])
