"""Readers for the captured tables and the JSON state files.

Every reader declares its schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


# Tables whose rows carry whole texts: parsing them is the expensive part.
TEXT_TABLES = {"pages", "documents"}
#: A text table of up to this size is one or two row groups, which a scan cannot split.
SMALL_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  How many splits a scan has is the reader's business
    (``spark.sql.files.maxPartitionBytes``).  Only a text table of a few
    megabytes, which would be parsed on one core, is spread over the cores;
    moving it costs nothing that counts on any cluster."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if name in TEXT_TABLES and bytes_of(spark, path) <= SMALL_BYTES:
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder in whatever store ``path`` names."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(jpath).getLength()


def read_captures(spark: SparkSession, path: str, schema: T.StructType = PAGES_SCHEMA) -> DataFrame:
    """Captured pages (url, html) standing in for single-URL fetches."""
    return spark.read.schema(schema).parquet(path)


def read_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Local documents as bytes, with file name and a type taken from the extension."""
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return df.select(
        "path",
        name.alias("file_name"),
        F.when(ext == "", F.lit("bin")).otherwise(ext).alias("file_type"),
        "length",
        "modificationTime",
        "content",
    )


# State files ---------------------------------------------------------------
# The reference keeps each store as one JSON document: a dictionary keyed by
# API key (usage) or by URL (cache) plus a few totals.  The readers accept that
# legacy document and turn it into one row per entry.  The scalable layout,
# written by ``merge_latest``, is JSON Lines with one entry per line.

USAGE_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("usedCredits", T.DoubleType()),
        T.StructField("lastChecked", T.StringType()),
        T.StructField("remainingCredits", T.DoubleType()),
        T.StructField("planCredits", T.DoubleType()),
    ]
)
USAGE_DOC = T.StructType(
    [
        T.StructField("keys", T.MapType(T.StringType(), USAGE_RECORD)),
        T.StructField("updatedAt", T.StringType()),
    ]
)
CACHE_ENTRY = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("tool", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("credits", T.DoubleType()),
    ]
)
CACHE_DOC = T.StructType(
    [
        T.StructField("scraped", T.MapType(T.StringType(), CACHE_ENTRY)),
        T.StructField("totalCreditsUsed", T.DoubleType()),
        T.StructField("monthlyBudget", T.DoubleType()),
        T.StructField("updatedAt", T.StringType()),
    ]
)

def iso_time(text: Column) -> Column:
    """An ISO 8601 time, with or without zone and fraction, as wall-clock time
    of the session's zone (UTC here); blank or unreadable text is null."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit(""))).cast("timestamp_ntz")


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def _read_doc(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not _path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def read_usage_ledger(spark: SparkSession, path: str) -> DataFrame:
    """S3: usage dictionary -> one row per key; a missing file is an empty table."""
    doc = _read_doc(spark, path, USAGE_DOC)
    rec = doc.select(F.explode("keys").alias("ledger_key", "r"))
    return rec.select(
        F.sha2(F.coalesce(F.col("r.key"), F.col("ledger_key")), 256).alias("key_hash"),
        F.col("r.usedCredits").cast("bigint").alias("used_credits"),
        F.col("r.remainingCredits").cast("bigint").alias("remaining_credits"),
        F.col("r.planCredits").cast("bigint").alias("plan_credits"),
        iso_time(F.col("r.lastChecked")).alias("last_checked"),
    )


def read_url_cache(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Cache dictionary -> (entries, totals); missing file -> empty entries, zero totals."""
    doc = _read_doc(spark, path, CACHE_DOC)
    entries = doc.select(F.explode("scraped").alias("cache_url", "e")).select(
        F.coalesce("e.url", "cache_url").alias("url"),
        F.col("e.tool").alias("tool"),
        F.coalesce("e.format", F.lit("markdown")).alias("format"),
        iso_time(F.col("e.timestamp")).alias("cached_at"),
        F.col("e.credits").cast("bigint").alias("credits"),
    )
    totals = doc.agg(
        F.coalesce(F.sum("totalCreditsUsed"), F.lit(0.0)).cast("bigint").alias("total_credits_used"),
        F.coalesce(F.sum("monthlyBudget"), F.lit(0.0)).cast("bigint").alias("monthly_budget"),
    )
    return entries, totals


# JSON Lines stores: one entry per line, written and read in parallel ---------

USAGE_LINE = T.StructType(
    [
        T.StructField("key_hash", T.StringType()),
        T.StructField("used_credits", T.LongType()),
        T.StructField("remaining_credits", T.LongType()),
        T.StructField("plan_credits", T.LongType()),
        T.StructField("last_checked", T.StringType()),
    ]
)
CACHE_LINE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("tool", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("credits", T.LongType()),
    ]
)


def state_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a state table inside the shared checkpoint folder."""
    import uuid

    from webledger.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/state/{name}-{uuid.uuid4().hex}"


def write_state(df: DataFrame, path: str) -> str:
    """Write a state table as JSON Lines (the scalable form of the stores)."""
    df.write.mode("overwrite").json(path)
    return path


def read_usage_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3 (scalable layout): the usage ledger, one JSON object per key."""
    return spark.read.schema(USAGE_LINE).option("mode", "PERMISSIVE").json(path).withColumn(
        "last_checked", iso_time(F.col("last_checked"))
    )


def read_cache_lines(spark: SparkSession, path: str) -> DataFrame:
    """S4 (scalable layout): URL cache entries, one JSON object per URL;
    timestamps are ISO strings as the reference writes them."""
    return spark.read.schema(CACHE_LINE).option("mode", "PERMISSIVE").json(path).select(
        "url", "tool", F.coalesce("format", F.lit("markdown")).alias("format"),
        iso_time(F.col("timestamp")).alias("cached_at"), "credits",
    )
