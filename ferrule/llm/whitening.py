"""Embedding whitening with Spark MLlib's BlockMatrix.

Method.  Components become integers, floor(scale * c) + shift, so that sums and deviations are exact.  The rows are
numbered (offsets of the stored partitions), centred and turned into a BlockMatrix of row blocks; its transpose times
itself is the scatter matrix.  That matrix, the width of a vector squared, is all that the driver gets: eigh finds the
unit eigenvectors there, and a second BlockMatrix multiplication by the whitening matrix (eigenvectors over the square
roots of their eigenvalues) projects all rows.  The covariance of the result is taken in the same way and held against
the identity.

Scale.  The scatter has one block however many rows there are, so the product over the row blocks is split into groups of
``_GROUP`` row blocks (``numMidDimSplits``) that are multiplied in tasks of their own and summed with a map-side combine.
Shuffled are the rows (to blocks, and to each of the products); sums per dimension are partial aggregates.  The driver
holds dimension^2 numbers and one (row, column) pair for each block of ``_BLOCK_BYTES``.

Defined cases: vectors that are null or hold a null or non-finite component take no part, an empty vector has no
component; vectors of each length are whitened by themselves, in ascending order of length; rows with null or repeated
ids are rows like others; a direction without variance (an eigenvalue below 1e-12 of the greatest) has no whitened value
and its component is left out, so that equal rows, or a single one, give no rows; an empty table gives an empty one;
other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import stored

_BLOCK_BYTES = 1 << 20
#: Row blocks that one task multiplies.
_GROUP = 4
SCHEMA = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """The stored rows with ``idx`` from 0 on: place in the partition that wrote them, plus the partition's offset."""
    spark = df.sparkSession
    kept = stored(spark, df.withColumn("part", F.spark_partition_id())
                  .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)
    sizes = kept.groupBy("part").count().orderBy("part").collect()           # one row for each partition
    at = np.concatenate([[0], np.cumsum([r["count"] for r in sizes], dtype=np.int64)])
    offset = spark.createDataFrame([(r["part"], int(a)) for r, a in zip(sizes, at)], "part int, first long")
    return kept.join(F.broadcast(offset), "part").withColumn("idx", F.col("first") + F.col("place")).drop("part", "place", "first")


def _sums(rows: DataFrame, col: str) -> list:
    """Sum of the column's arrays, dimension by dimension."""
    out = rows.select(F.posexplode(col).alias("d", "v")).groupBy("d").agg(F.sum("v").alias("s")).collect()
    return [r["s"] for r in sorted(out, key=lambda r: r["d"])]


def _numbers(values, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _blocks(rows: DataFrame, width: int) -> BlockMatrix:
    """(idx, z) rows as row blocks of a matrix."""
    per_block = max(1, _BLOCK_BYTES // (8 * width))
    vectors = rows.select("idx", array_to_vector("z").alias("z"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "z")).toBlockMatrix(per_block, width)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """transpose(M) * M."""
    groups = max(1, -(-matrix.numRowBlocks // _GROUP))
    left = matrix.transpose()
    # the method's second argument, the number of groups of row blocks, is not in the Python signature
    product = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(product, left.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix whose columns whiten, each component's share of the variance)."""
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > 1e-12 * max(values[0], 0)).sum()))
    return vectors[:, :keep] / np.sqrt(values[:keep]), values[:keep] / np.trace(scatter / n)


def whiten(spark: SparkSession, rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32,
           scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row and component."""
    x = F.col(vec_col).cast("array<double>")
    good = (rows.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
            .filter("x is not null and size(x) > 0 and forall(x, v -> v is not null and not isnan(v) and abs(v) < double('Infinity'))")
            .select("id", F.transform("x", lambda c: F.floor(c * scale) + shift).alias("x")))
    good = stored(spark, good, "vectors")
    widths = sorted(r["w"] for r in good.groupBy(F.size("x").alias("w")).count().collect())
    parts = [p for w in widths if (p := _whiten(spark, good.filter(F.size("x") == w), w, components)) is not None]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCHEMA)


def _whiten(spark: SparkSession, good: DataFrame, width: int, components: int) -> DataFrame | None:
    kept = _numbered(good, "rows")
    n = kept.count()
    total = _sums(kept, "x")
    base = [s // n for s in total]                            # x = base + y, S = n * base + r
    r = [s - n * b for s, b in zip(total, base)]
    y = F.zip_with("x", _numbers(base, "long"), lambda a, b: a - b)
    kept = kept.select("id", "idx", y.alias("y"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0).cast("long"), lambda s, v: s + v)
    # sum (n x - S)^2 = n^2 sum y^2 - 2 n sum y r + sum r^2: small factors in 64 bits, their products as decimals
    big = [F.lit(str(v)).cast("decimal(38,0)") for v in (n, sum(v * v for v in r))]
    yy, yr = (F.col(c).cast("decimal(38,0)") for c in ("yy", "yr"))
    exact = (kept.select("id", "idx", "y", dot(F.col("y"), F.col("y")).alias("yy"), dot(F.col("y"), _numbers(r, "long")).alias("yr"))
             .withColumn("deviation", (big[0] * (big[0] * yy - 2 * yr).cast("decimal(38,0)") + big[1]).cast("decimal(38,0)")))
    centred = exact.select("id", "idx", "deviation", F.zip_with("y", _numbers([v / n for v in r], "double"), lambda a, m: a - m).alias("z"))
    centred = stored(spark, centred, "centred")

    matrix = _blocks(centred, width)
    to_white, share = whitening_matrix(_scatter(matrix), n, components)
    c = to_white.shape[1]
    if not c:
        return None
    one = spark.sparkContext.parallelize([((0, 0), Matrices.dense(width, c, to_white.ravel("F").tolist()))], 1)
    projected = matrix.multiply(BlockMatrix(one, width, c)).toIndexedRowMatrix().rows
    white = spark.createDataFrame(projected.map(lambda p: (int(p.index), p.vector.toArray().tolist())), "idx long, w array<double>")
    white = stored(spark, white, "white")

    mean = [s / n for s in _sums(white, "w")]
    again = _blocks(white.select("idx", F.zip_with("w", _numbers(mean, "double"), lambda a, m: a - m).alias("z")), c)
    error = float(np.abs(_scatter(again) / n - np.eye(c)).max())
    each = centred.select("id", "idx", "deviation").join(white, "idx").select("id", "deviation", F.posexplode("w").alias("k", "whitened"))
    return each.select(F.col("id").alias("vec_id"), (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                       "deviation", "whitened", _numbers(share.tolist(), "double")[F.col("k")].alias("explained"), F.lit(error).alias("identity_error"))
