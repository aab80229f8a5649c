"""Session construction and the shared checkpoint folder.

Library code never picks its own storage on a cluster: lineage is cut with
``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only a local session (tests, bench) without that
setting gets a fresh scratch folder.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "webledger") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Per-key state of the stream jobs lives in RocksDB, off the JVM heap.
        .config(STATE_STORE, ROCKSDB)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local sessions.

    The cluster's ``spark.checkpoint.dir`` wins whenever it is set.  A
    non-local master without it is a configuration error: a machine-local
    folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns spark.checkpoint.dir)
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="webledger-ckpt-"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, so that
    functions sent to them import it wherever the workers run."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="webledger-py-")) / "webledger.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


STORE_UPKEEP = "spark.sql.streaming.stateStore.maintenanceInterval"


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB, unless the session
    already uses a store of its own choice.  Spark's plain default has no list
    states or timers, so a stateful processor cannot start on it.

    Executors give up the local files of a stream that has ended (4 MB at least
    for each partition) at the next upkeep; by default a minute may go by, and
    a stream run in steps leaves such files with each step."""
    if spark.conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    if spark.conf.get(STORE_UPKEEP, "60000ms") in ("60000ms", "60s", "1m", "1min", "60000"):
        spark.conf.set(STORE_UPKEEP, "5s")


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable, not local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, label: str):
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: cut lineage whose size the engine knows, so that it can broadcast
    the table as long as it is small."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(df, key: str | list[str], buckets: int, label: str):
    """Write ``df`` as a table bucketed by ``key`` in the shared checkpoint
    folder and read it back.  Joins on ``key`` against it then shuffle only
    the other side; the write also cuts lineage (a reliable copy)."""
    import uuid

    spark = df.sparkSession
    name = f"webledger_{label}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._webledger_table = name  # so a superseded copy can be dropped from the catalog
    return out


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark):
    """A write in this block leaves no shuffle files behind, which would else stay
    until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def append_bucketed(df, to, key: str, buckets: int) -> None:
    """Append ``df`` to the ``bucketed_table`` that ``to`` reads; ``reread`` it afterwards."""
    df.select(*to.columns).write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(to._webledger_table)


def reread(df):
    """The present rows of a ``bucketed_table``."""
    spark = df.sparkSession
    spark.catalog.refreshTable(df._webledger_table)
    out = spark.table(df._webledger_table)
    out._webledger_table = df._webledger_table
    return out


def drop_bucketed(df) -> None:
    """Drop a superseded ``bucketed_table`` and its files."""
    name = getattr(df, "_webledger_table", None)
    if name:
        spark = df.sparkSession
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_folder(spark, path)


def delete_folder(spark, path: str) -> None:
    """Delete a folder this library wrote, in whatever store ``path`` names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
