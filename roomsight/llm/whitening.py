"""Whitening of embeddings with block matrices of Spark's MLlib.

Entries are put on a grid (``x = floor(64 * c) + 1000000``), so that sums and differences are whole
numbers and exact. The fit list has each grid vector once, however many rows share it; its rows, centred by
``(n * x - S) / n``, are numbered and indexed into a BlockMatrix. Its transpose times itself is
the scatter matrix: the products of the row blocks are made apart and then summed, so no task sees more than a
few blocks. The driver gets that square of the dimension only, and numpy's ``eigh`` gives the
components. A second product, of the centred rows and the whitening matrix, projects the rows, and a
third one, of the projected fit list with itself, measures how far its covariance is from the identity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 1_024
BLOCK_COLUMNS = 1_024
BLOCKS_A_TASK = 8
#: Least share of the trace that a component must explain; less is rounding.
LEAST = 1e-12


@dataclass(frozen=True)
class Whitening:
    """What was learned: size and sums of the fit list, eigenvalues and unit eigenvectors (columns)
    in falling order, the trace, and the largest entry of whitened covariance minus identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def gridded(embeddings: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, x) of the rows that remain, written once.

    Left out are rows whose vector is NULL or empty, has a NULL or non-finite entry or one whose x is beyond a
    long, or has another length than most vectors have (the smaller length of equally frequent ones).
    """
    entry = lambda c: F.try_add(F.floor(c.cast("double") * SCALE), F.lit(OFFSET).cast("long"))
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = embeddings.select(F.col(ident).alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", fine) & (F.size("v") > 0))
    rows = rows.select("vec_id", F.transform("v", entry).alias("x")).where(
        F.forall("x", lambda c: c.isNotNull()))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("x") == F.lit(length["d"] if length else 0))
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def _numbered(rows: DataFrame, by: str) -> DataFrame:
    """Column ``index``: consecutive numbers from 0, from the written ids ``by`` of the tasks.

    The driver gets one count per task that wrote the rows.
    """
    part = F.shiftrightunsigned(by, 33)
    counts = sorted((r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect())
    at, before = 0, []
    for p, n in counts:
        before.append((p, at))
        at += n
    first = rows.sparkSession.createDataFrame(before, "_part long, _first long")
    local = F.col(by).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_part", part).join(F.broadcast(first), "_part").withColumn(
        "index", F.col("_first") + local).drop("_part", "_first")


def _fits(value: int) -> bool:
    return -(1 << 63) <= value < 1 << 63


def differences(n: int, sums: list[int]) -> Column:
    """n * x - S of a row; an entry beyond a long is NULL."""
    total = F.array(*[F.lit(s if _fits(s) else None).cast("long") for s in sums])
    return F.zip_with("x", total, lambda v, s: F.try_subtract(F.try_multiply(v, F.lit(n).cast("long")), s))


def centred(n: int, sums: list[int]) -> Column:
    """x - S / n of a row, from the whole differences where they fit a long."""
    mean = F.array(*[F.lit(s / n) for s in sums])
    rough = F.zip_with("x", mean, lambda v, m: v.cast("double") - m)
    return F.zip_with(differences(n, sums), rough,
                      lambda d, r: F.coalesce(d.cast("double") / F.lit(float(n)), r))


def _blocks(rows: DataFrame, index: str, values: Column, size: int, dimension: int) -> BlockMatrix:
    """Rows (index, values) as a BlockMatrix of ``size`` rows."""
    given = rows.select(F.col(index).alias("index"), array_to_vector(values).alias("vector"))
    given = MLUtils.convertVectorColumnsFromML(given, "vector")
    matrix = IndexedRowMatrix(given, size, dimension)
    return matrix.toBlockMatrix(BLOCK_ROWS, min(dimension, BLOCK_COLUMNS))


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times itself, in parts of ``BLOCKS_A_TASK`` row blocks that are then summed."""
    flat = blocks.transpose()
    parts = max(1, -(-(-(-blocks.numRows() // BLOCK_ROWS)) // BLOCKS_A_TASK))
    java = flat._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(java, flat.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _projected(blocks: BlockMatrix, weights: np.ndarray) -> BlockMatrix:
    """The rows times ``weights`` (dimension, components), which is cut into blocks likewise."""
    context = blocks._java_matrix_wrapper._sc
    d, k = weights.shape
    step = blocks.colsPerBlock
    pieces = [((i // step, 0), Matrices.dense(len(weights[i:i + step]), k,
                                              weights[i:i + step].ravel(order="F").tolist()))
              for i in range(0, d, step)]
    return blocks.multiply(BlockMatrix(context.parallelize(pieces, 1), step, k, d, k))


def _rows_of(blocks: BlockMatrix) -> DataFrame:
    """(index, y array<double>) of a BlockMatrix."""
    matrix = blocks.toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("y"))


def learn(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of gridded rows; None without rows. At most ``components`` components, only such
    with a share of the trace above ``LEAST``."""
    fit = cut_lineage(rows.select("x").distinct().withColumn("fit", F.monotonically_increasing_id()))
    found = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    if not found:
        return None
    n, sums = found[0]["n"], [int(r["s"]) for r in sorted(found, key=lambda r: r["at"])]
    d = len(sums)
    blocks = _blocks(_numbered(fit, "fit"), "index", centred(n, sums), n, d)
    cov = _scatter(blocks) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(cov))
    k = int((values[:components] > LEAST * trace).sum()) if trace > 0 else 0
    values, vectors = values[:k], vectors[:, :k]
    error = 0.0
    if k:
        white = _projected(blocks, vectors / np.sqrt(values))
        mean = _rows_of(white).agg(*[F.avg(F.col("y")[i]) for i in range(k)]).first()
        mean = np.array([mean[i] for i in range(k)])
        error = float(np.abs(_scatter(white) / n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, trace, error)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (array, one entry per component) of gridded rows.

    deviation is NULL where it is beyond a long.
    """
    size = rows.count()
    numbered = cut_lineage(_numbered(rows, "row"))
    blocks = _blocks(numbered, "index", centred(model.n, model.sums), size, len(model.sums))
    white = _rows_of(_projected(blocks, model.vectors / np.sqrt(model.values)))
    square = F.aggregate(differences(model.n, model.sums), F.lit(0).cast("long"),
                         lambda total, v: F.try_add(total, F.try_multiply(v, v)))
    return numbered.select("index", "vec_id", square.alias("deviation")).join(white, "index").select(
        "vec_id", "deviation", F.col("y").alias("whitened"))


def report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every
    row and component.

    Which rows are left out says ``gridded``. Repeated vectors count once in the fit and are projected each;
    a NULL or repeated vec_id is like any other. Without rows, or where all vectors are equal, there is no
    component and no row. Vectors of fewer dimensions have as many components as these, but for those without
    variance. Columns other than the two are not read.
    """
    rows = gridded(embeddings)
    model = learn(rows, components)
    ident = rows.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {ident}, component int, n long, deviation long, whitened double, "
                "explained double, identity_error double")
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return project(rows, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", share[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))
