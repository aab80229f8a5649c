"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.session import ensure_checkpoint_dir, ship_package

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark, so any file system Spark knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_python(df: DataFrame) -> DataFrame:
    """``df``, after making sure the Python workers can import this package."""
    ship_package(df.sparkSession)
    return df


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: computed
    once, no lineage left, and any executor can read it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one folder that ``scratch_path`` named."""
    if not urlsplit(path).path.startswith(urlsplit(ensure_checkpoint_dir(spark)).path):
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables of one operator in the shared folder, deleted on
    leaving the ``with`` block.  What is read later must be written outside it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


def splittable(key: str) -> Column:
    """The long column ``key`` as a join key that no earlier exchange is known
    to be dealt by.  Joined on this, an aggregated side gets an exchange of
    its own, and only then can Spark split a hot key on the other side."""
    return F.col(key).bitwiseXOR(F.lit(1))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """``batches`` in pieces of at most ``rows`` rows, so that few whole texts are Python objects at a time.

    After each batch the worker gives back memory it no longer uses, which it would else keep for the
    next task while other workers need it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()
