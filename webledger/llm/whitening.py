"""Embedding whitening with MLlib's BlockMatrix (operator 13).

The distinct quantised vectors, centred, are numbered and become a
``BlockMatrix`` whose blocks hold ``BLOCK`` rows each.  Its transpose times
itself is the scatter matrix, whose eigenvectors (numpy, on the driver: one
number per pair of dimensions) give the whitening matrix; a further product
with that projects the rows.

A product has all blocks of a sum meet in the task of its result block, and
the scatter matrix is a single block.  So its sum is split over as many
tasks as there are groups of ``TOGETHER`` blocks, which are then added up.  MLlib
also sends the places of all blocks to the driver; rows are therefore taken
in slabs of ``SLAB`` rows, each a matrix of its own, and slabs' scatters are
added.

Input cases: vectors that are null or hold a null, NaN or infinite component
are dropped; a vector shorter than the longest is filled with zeros; a
repeated vector counts once in the fit, and each of its rows is returned, also
without or with a repeated vec_id; components whose eigenvalue is zero (to
double precision) cannot be whitened and are left out, so equal vectors alone
give no rows; ``deviation`` is null where it does not fit a long; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webledger.llm.common import table, written
from webledger.llm.topk import quantised, usable

#: Rows of a block, blocks that one task adds up, and rows of a slab.
BLOCK, TOGETHER, SLAB = 1024, 64, 1 << 26
COMPONENTS = 4


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written with an ``index`` 0, 1, ... over all rows; only the
    number of rows of each partition reaches the driver."""
    local = written(df.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    sizes = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in sizes)])[:-1].tolist()
    first = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts, strict=True)], "part int, start long")
    return local.join(F.broadcast(first), "part").withColumn("index", F.col("start") + F.col("place")).drop("part", "place", "start")


def indexed(rows: DataFrame, values: Column) -> IndexedRowMatrix:
    """``rows`` (index) as a distributed matrix of ``values``, an array column."""
    vectors = rows.select(F.col("index").cast("long"), array_to_vector(values).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"))


def product(left: BlockMatrix, right: BlockMatrix, tasks: int) -> BlockMatrix:
    """left x right, the sums of its blocks split over ``tasks`` tasks."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(rows: DataFrame, values: Column, n: int, width: int) -> np.ndarray:
    """The sum over all ``rows`` of each one's ``values`` times themselves."""
    out = np.zeros((width, width))
    for low in range(0, n, SLAB):
        slab = rows.where(F.col("index").between(low, low + SLAB - 1)).withColumn("index", F.col("index") - low)
        blocks = indexed(slab, values).toBlockMatrix(BLOCK, width).cache()
        out += product(blocks.transpose(), blocks, -(-min(n, SLAB) // (BLOCK * TOGETHER))).toLocalMatrix().toArray()
        blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return out


def projected(spark: SparkSession, rows: DataFrame, values: Column, matrix: np.ndarray, n: int, label: str) -> DataFrame:
    """index, z: the ``values`` of each row times ``matrix``."""
    width, kept = matrix.shape
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(width, kept, matrix.T.reshape(-1).tolist()))], 1), width, kept)
    out = None
    for low in range(0, n, SLAB):
        slab = rows.where(F.col("index").between(low, low + SLAB - 1)).withColumn("index", F.col("index") - low)
        of = product(indexed(slab, values).toBlockMatrix(BLOCK, width), right, 1).toIndexedRowMatrix()
        found = callMLlibFunc("getIndexedRows", of._java_matrix_wrapper._java_model).toDF("index", "vector")
        found = written(found.select((F.col("index") + low).alias("index"), vector_to_array("vector").alias("z")), label)
        out = found if out is None else out.unionByName(found)
    return out


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row and component."""
    spark = vectors.sparkSession
    points = written(vectors.where(usable(F.col(vector))).select(F.col(id_column).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("x")), "points")
    width = points.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if not width:
        return spark.createDataFrame([], T._parse_datatype_string(RESULT))
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    points = points.withColumn("x", F.when(F.size("x") < width, filled).otherwise(F.col("x")))
    fit = written(numbered(points.select("x").distinct(), "fit"), "fit-numbered")
    sums = fit.agg(F.count(F.lit(1)), *[F.try_sum(F.col("x")[i]) for i in range(width)], *[F.sum(F.col("x")[i].cast("double")) for i in range(width)]).first()
    n, exact, mean = sums[0], sums[1 : width + 1], np.array(sums[width + 1 :]) / sums[0]
    mean = np.array([mean[i] if s is None else s / n for i, s in enumerate(exact)])

    centred = F.zip_with("x", F.lit(mean.tolist()), lambda a, b: a.cast("double") - b)
    values, axes = np.linalg.eigh(scatter(fit, centred, n, width) / n)
    total, kept = values.sum(), [i for i in np.argsort(-values, kind="stable")[:components].tolist() if values[i] > 1e-12 * max(values.max(), 0)]
    if not kept:
        return spark.createDataFrame([], T._parse_datatype_string(RESULT))
    z = projected(spark, fit, centred, axes[:, kept] / np.sqrt(values[kept]), n, "projected")

    # The covariance of what came out, centred first.
    middle = z.agg(*[F.avg(F.col("z")[i]) for i in range(len(kept))]).first()
    pairs = [(i, j) for i in range(len(kept)) for j in range(i + 1)]
    moments = z.agg(*[F.avg((F.col("z")[i] - middle[i]) * (F.col("z")[j] - middle[j])) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(moments, pairs, strict=True))

    if None in exact:
        deviation = F.lit(None).cast("long")
    else:
        off = F.zip_with("x", F.lit(list(exact)).cast("array<long>"), lambda a, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), a), s))
        deviation = F.aggregate(off, F.lit(0).cast("long"), lambda acc, t: F.try_add(acc, F.try_multiply(t, t)))
    known = fit.join(z, "index").select(F.col("x").alias("of_x"), "z")
    each = points.join(known, F.col("x") == F.col("of_x")).select("vec_id", deviation.alias("deviation"), F.posexplode("z").alias("at", "whitened"))
    share = F.lit([float(values[i] / total) for i in kept])
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
