"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; the
last returns packed pieces.  ``run`` writes each stage's rows as Parquet in
the shared folder and reads them again for the next stage.

Input cases: a row is kept or dropped by its own verdict, so rows that repeat a
doc_id with other texts are other documents, and of copies exactly one row
stays, whether their doc_ids are equal, different or null (a row without
doc_id only if no copy has one).  A null text counts as empty in the dedup
stages and is rejected by the language stage, as is one without a letter.
Further columns go through unchanged; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm import language, naming, packing, secrets, simhash
from webledger.llm.common import table, written

#: Name of the column that numbers the rows within a stage.
ROW = "row of the stage"


def kept(numbered: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``numbered`` that stay, by each row's own verdict."""
    rows = verdicts.where("stays").select(F.col(ROW).alias("kept row"))
    return numbered.join(rows, F.col(ROW) == F.col("kept row"), "left_semi").drop(ROW)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a number for each row, so that every later reading sees the same numbers."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; those it rejects go."""
    return language.accepted(docs, language.learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays; of several such rows, one."""
    rows = numbered(docs)
    return kept(rows, naming.exact_groups(rows, row=ROW))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose fingerprints are linked, the one with the smallest doc_id
    stays; of several such rows, one."""
    rows = numbered(docs)
    return kept(rows, simhash.near_groups(rows, row=ROW))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark, and n_chars by the new length."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Language prediction, fingerprints and compression aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
