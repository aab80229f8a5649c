"""Exact dedup by deterministic block naming (operator 8); native DataFrame operations only.

Two texts can be equal only if length and 64-bit hash agree, so documents
alone with their (length, hash) are their own class at once.  All others are
decided without trusting the hash: their texts are cut into blocks of a fixed
number of characters, the distinct blocks are sorted and numbered, and then
adjacent pairs of names are sorted and numbered in turn, over and over, until each
document has one name.  Equal names at the end mean equal texts, character by
character.

Input cases: a null text counts as empty; texts are compared after each run of
ASCII white space has become one space; rows that repeat a doc_id and its text
are each counted in ``group_size`` and share one verdict; a null doc_id never
wins over a number; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm.common import Scratch, splittable, table, written

#: Characters of a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def names_of(values: DataFrame, columns: list[str], label: str, keep: Scratch) -> DataFrame:
    """The distinct rows of ``columns`` with an integer ``name`` each.

    Equal rows meet in one task of the ``distinct``, by a hash of theirs; there
    they are sorted, by a 64-bit hash first and then by themselves, so equal
    hashes do no harm.  A name is the task's number and the place in it, and is
    fixed once written.  No task holds all rows, and none reaches the driver.
    """
    ordered = values.select(*columns).distinct().sortWithinPartitions(F.xxhash64(*columns), *columns)
    return keep.written(ordered.withColumn("name", F.monotonically_increasing_id()), label)


def document_names(texts: DataFrame, keep: Scratch, block: int = BLOCK) -> DataFrame:
    """``texts`` (row, norm) to (row, blocks, name): within equal ``blocks``,
    equal names stand for equal texts and no others."""
    cut = F.regexp_extract_all("norm", F.lit(rf"(?s).{{1,{block}}}"), F.lit(0))
    cut = F.when(F.size(cut) == 0, F.array(F.lit(""))).otherwise(cut)
    pieces = keep.written(
        texts.select("row", cut.alias("cut")).select("row", F.size("cut").alias("blocks"), F.posexplode("cut").alias("pos", "block")), "blocks"
    )
    names = names_of(pieces, ["block"], "block-names", keep).withColumnRenamed("block", "named")
    level = keep.written(pieces.join(names, F.col("block") == F.col("named")).select("row", "blocks", "pos", "name"), "level")
    most = level.agg(F.max("blocks")).first()[0] or 1
    ready = level.where("blocks = 1")
    width = 1
    while width < most:
        width *= 2
        pairs = keep.written(
            level.where(F.col("blocks") > width // 2)
            .groupBy("row", "blocks", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")),
            "pairs",
        )
        names = names_of(pairs, ["a", "b"], "pair-names", keep).select(F.col("a").alias("x"), F.col("b").alias("y"), "name")
        level = keep.written(
            pairs.join(names, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y"))).select("row", "blocks", "pos", "name"), "level"
        )
        ready = ready.unionByName(level.where(F.col("blocks").between(width // 2 + 1, width)))
    return ready.select("row", "blocks", "name")


def exact_groups(docs: DataFrame, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    With ``row``, a column that numbers the rows, also this number and ``stays``,
    true for exactly one row of each class: of the smallest doc_id's rows the first.
    """
    spark = docs.sparkSession
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    with Scratch(spark) as keep:
        norm = docs.select(number.alias("row"), F.col("doc_id").cast("long"), normalised(F.col("text")).alias("norm"))
        keyed = keep.written(
            norm.select(
                "row", "doc_id", "norm", F.length("norm").alias("len"), F.xxhash64("norm").alias("hash"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
            ),
            "keyed",
        )
        shared = (
            keyed.groupBy("len", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("len").alias("of_len"), splittable("hash").alias("of_hash"))
        )
        # The shared buckets' side is exchanged too, so a hot bucket of texts can be split.
        candidates = keyed.join(shared, (F.col("len") == F.col("of_len")) & (splittable("hash") == F.col("of_hash")), "left_semi")
        named = document_names(candidates.select("row", "norm"), keep, block).withColumnRenamed("row", "named_row")
        identity = written(
            keyed.select("row", "doc_id", "text_sha256").join(named, F.col("row") == F.col("named_row"), "left").drop("named_row"), "identity"
        )
    alone = identity.where("name is null").select(
        "row", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256", F.col("row").alias("keep_row")
    )
    together = identity.where("name is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    groups = together.groupBy("blocks", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")).select(
        F.col("blocks").alias("of_blocks"), splittable("name").alias("of_name"), F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"
    )
    joined = together.join(groups, (F.col("blocks") == F.col("of_blocks")) & (splittable("name") == F.col("of_name")))
    every = alone.unionByName(joined.select(*alone.columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return every.select(*columns) if row is None else every.select(F.col("row").alias(row), *columns, (F.col("row") == F.col("keep_row")).alias("stays"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


#: DuckDB text of op8.
OP8_SQL = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, sha256(norm) as text_sha256
from t window g as (partition by norm)
"""
