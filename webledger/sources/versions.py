"""State tables published in versions.

A version's rows are written to a folder of their own; when that is complete,
a row that names the folder is appended to the pointer table, in one commit of
Spark's writer.  Readers look only at the pointers, so a write that breaks off
leaves the version before it as it was, and a version being read is never
overwritten.  One writer at a time publishes to a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webledger.operators.payload import merge_latest
from webledger.session import delete_folder

POINTER = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("published", T.TimestampType()),
])


class VersionedTable:
    """A table of ``schema`` under ``path``, of which the last ``keep`` versions stay readable."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 3) -> None:
        if keep < 1:
            raise ValueError("keep must be 1 or more")
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def _pointers(self) -> list[tuple[int, str]]:
        """(version, folder) of all that was ever published, oldest first: a short row for each."""
        # The glob makes a folder that is not there yet an empty table.
        found = self.spark.read.schema(POINTER).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        try:
            rows = found.parquet(f"{self.path}/pointers").collect()
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted((r["version"], r["folder"]) for r in rows)

    def versions(self) -> list[int]:
        """The versions that can be read."""
        return [v for v, _ in self._pointers()[-self.keep :]]

    def read(self, version: int | None = None) -> DataFrame:
        """A version, by default the last; an empty table if none is published."""
        known = dict(self._pointers()[-self.keep :])
        if version is None:
            if not known:
                return self.spark.createDataFrame([], self.schema)
            version = max(known)
        if version not in known:
            raise ValueError(f"version {version} is not there; there are {sorted(known)}")
        return self.spark.read.schema(self.schema).parquet(known[version])

    def publish(self, rows: DataFrame) -> int:
        """``rows`` as the next version; nothing changes for readers unless all of it is written."""
        before = self._pointers()
        version = before[-1][0] + 1 if before else 1
        folder = f"{self.path}/data/v{version}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(folder)
        pointer = self.spark.createDataFrame([(version, folder)], "version long, folder string").withColumn("published", F.current_timestamp())
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path}/pointers")
        # Versions that left with this one; of earlier ones a crash may have left the folder, which no pointer in use names.
        gone = before[: max(0, len(before) + 1 - self.keep)][-1:]
        for _, old in gone:
            delete_folder(self.spark, old)
        return version

    def merge(self, updates: DataFrame, key: list[str], order: list[str]) -> int:
        """The last version with ``updates`` merged in (``merge_latest``), as the next one."""
        return self.publish(merge_latest(self.read(), updates, key, order))
