"""Stress K2 with one URL holding a third of a large log; compare with a
sequential fold in plain Python and report the time and the balance of the
range-partitioned scan."""

import datetime as dt
import random
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from webledger.operators.replay import replay_cache  # noqa: E402
from webledger.session import build_session  # noqa: E402

n = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
rnd = random.Random(11)
t0 = dt.datetime(2024, 1, 1)
rows = []
for i in range(n):
    hot = i % 3 == 0
    url = "https://hot.example/" if hot else f"https://s{rnd.randint(0, 5000)}.example/"
    fmt = "markdown" if (hot and rnd.random() < 0.98) else rnd.choice(["markdown", "json"])
    rows.append((i, url, fmt, t0 + dt.timedelta(seconds=rnd.randint(0, 60 * 86400)), "scrape", 1))

spark = build_session()
df = spark.createDataFrame(rows, "request_id long, url string, format string, ts timestamp_ntz, tool string, credits long")
df = df.repartition(16).cache()
df.count()
start = time.time()
got = {r.request_id: r.hit for r in replay_cache(df).select("request_id", "hit").collect()}
took = time.time() - start

want, entry = {}, {}
for rid, url, fmt, ts, _, _ in sorted(rows, key=lambda r: (r[1], r[3], r[0])):
    e = entry.get(url)
    hit = e is not None and ts - e[1] <= dt.timedelta(hours=24) and e[0] == fmt
    if not hit:
        entry[url] = (fmt, ts)
    want[rid] = hit

spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
spark.conf.set("spark.sql.shuffle.partitions", "32")
parts = (df.orderBy("url", "ts", "request_id").withColumn("p", F.spark_partition_id()).groupBy("p")
         .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url") == "https://hot.example/").alias("hot")).collect())
sizes = sorted(r.n for r in parts)
print(f"rows={n} hot_share=1/3 replay_seconds={took:.1f} equal_to_fold={got == want} "
      f"hits={sum(got.values())} partitions={len(sizes)} max/avg={max(sizes) / (sum(sizes) / len(sizes)):.2f} "
      f"partitions_holding_hot={sum(1 for r in parts if r.hot)}")
spark.stop()
