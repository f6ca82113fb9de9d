"""Whitening of embeddings with MLlib's distributed block matrices.

Vectors are whole numbers (``fixed_point`` makes them), so counts, sums and deviations are exact.
The covariance is that of the distinct vectors, each counted once, so copies have no weight.

1. The distinct vectors are written once; their number and sums per dimension follow from one
   aggregate, in decimals.
2. Centred rows ``(n x - S) / n`` are indexed without gaps and dealt into blocks of an
   ``IndexedRowMatrix``. Transpose times matrix gives the scatter; the middle dimension is split, so
   that a task adds up a few blocks and no task receives them all.
3. Only the square scatter, whose size follows from the dimensions, reaches the driver, for ``eigh``.
4. The block matrix of all rows, times the block of scaled eigenvectors, is the projection.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry, or one beyond
long range, take no part. All vectors should be equally long; of several lengths, the one that most
distinct vectors have takes part (the longer of equals). Equal vectors, equal ids and null ids give
a row for each input row. Directions without spread (eigenvalue below 1e-10 of the largest) cannot
be scaled to one and have no rows; so a single distinct vector, or none, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmill.llm.common import carried, fields, released, staged

BLOCK_ENTRIES = 1 << 17
BLOCKS_A_TASK = 8
LEAST_EIGENVALUE = 1e-10
PART_BITS = 33  # monotonically_increasing_id keeps the row's place below, the partition above
EXACT = "decimal(38,0)"
LONG = 1 << 62


def fixed_point(vector: Column, steps: int, shift: int) -> Column:
    """``floor(steps * entry) + shift`` of every entry; null for vectors that take no part."""
    def usable(entry: Column) -> Column:
        value = entry.cast("double")
        return F.coalesce(F.abs(value) * steps < F.lit(float(LONG - abs(shift))), F.lit(False))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * steps) + F.lit(shift))
    return F.when((F.size(vector) > 0) & F.forall(vector, usable), whole)


def _indexed(rows: DataFrame, label: str) -> DataFrame:
    """The rows, stored, with ``idx`` from 0 without gaps."""
    stored = staged(rows.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.shiftright("at", PART_BITS).alias("part")
    sizes = stored.groupBy(part).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each written partition.
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("at").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return (stored.withColumn("part", part).join(offsets, "part")
            .withColumn("idx", F.col("offset") + place).drop("part", "offset", "at"))


def _sums(distinct: DataFrame) -> DataFrame:
    """``dim``, ``at``, exact ``total`` and ``n`` of distinct vectors by length and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy()
            flat = batch.column(0).flatten().to_numpy()
            for dim in np.unique(sizes).tolist():
                own = flat[np.repeat(sizes, sizes) == dim].reshape(-1, dim)
                if float(np.abs(own.astype(float)).max()) * len(own) >= LONG:
                    own = own.astype(object)
                totals[dim] = totals.get(dim, 0) + own.sum(axis=0).astype(object)
                counts[dim] = counts.get(dim, 0) + len(own)
        for dim, total in totals.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()),
                "total": pa.array([Decimal(v) for v in total], pa.decimal128(38, 0)),
                "n": pa.array([counts[dim]] * dim, pa.int64())})
    sent = distinct.select("x").mapInArrow(released(run), f"dim int, at int, total {EXACT}, n bigint")
    return sent.groupBy("dim", "at").agg(F.sum("total").cast(EXACT).alias("total"),
                                         F.sum("n").alias("n"))


@dataclass
class Fit:
    """Number and sums of the distinct vectors, eigenvalues by fall, eigenvectors in columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _centred(rows: DataFrame, n: int, sums: list[int], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, ``deviation`` (sum of squares of n x - S) and ``row``, (n x - S) / n."""
    most = max(map(abs, sums))
    limit = int(np.sqrt(2.0 ** 62 / len(sums)))
    exact = np.array(sums, object)
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(columns.index("x")).flatten().to_numpy().reshape(batch.num_rows, -1)
            # Python's whole numbers where 64 bits might not do.
            wide = n * float(np.abs(x.astype(float)).max()) + most >= LONG
            off = n * x.astype(object) - exact if wide else n * x - exact.astype(np.int64)
            if not wide and np.abs(off).max() > limit:
                off = off.astype(object)
            squares = (off * off).sum(axis=1)
            centred = off.astype(float) / n
            yield pa.RecordBatch.from_pydict({
                **{k: batch.column(columns.index(k)) for k in keep},
                "deviation": pa.array([Decimal(int(v)) for v in squares], pa.decimal128(38, 0)),
                "row": pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), centred.ravel())})
    return rows.mapInArrow(released(run), fields(rows, keep, f"deviation {EXACT}, row array<double>"))


def _blocks(rows: DataFrame, dim: int) -> BlockMatrix:
    """Block matrix of ``idx`` and ``row``; a block holds whole rows."""
    pairs = rows.select("idx", array_to_vector("row").alias("row"))
    pairs = MLUtils.convertVectorColumnsFromML(pairs, "row")
    per_block = max(1, BLOCK_ENTRIES // dim)
    return IndexedRowMatrix(pairs, numCols=dim).toBlockMatrix(per_block, dim)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Product with the middle dimension split; ``BlockMatrix.multiply`` leaves it whole."""
    java = left._java_matrix_wrapper._java_model.multiply(
        right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def fit(distinct: DataFrame) -> Fit | None:
    """Covariance of stored, distinct vectors ``x`` and its eigenvectors; None without a vector."""
    found = _sums(distinct).orderBy("dim", "at").collect()
    if not found:
        return None
    counts = {r["dim"]: r["n"] for r in found}
    dim = max(counts, key=lambda d: (counts[d], d))
    n, sums = counts[dim], [int(r["total"]) for r in found if r["dim"] == dim]
    rows = _indexed(distinct.where(F.size("x") == dim), "fit")
    matrix = _blocks(_centred(rows, n, sums, ["idx"]), dim)
    splits = -(-matrix.numRowBlocks // BLOCKS_A_TASK)
    scatter = _times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    spread = values > LEAST_EIGENVALUE * max(values[0], 0.0)
    return Fit(n, sums, values[spread], vectors[:, spread], float(np.trace(covariance)))


def project(rows: DataFrame, model: Fit, components: int) -> DataFrame:
    """``idx`` and ``whitened`` (array of double) of indexed, centred rows."""
    dim = len(model.sums)
    weights = model.scaled()[:, :components]
    sc = rows.sparkSession.sparkContext
    block = BlockMatrix(sc.parallelize([((0, 0), DenseMatrix(
        dim, weights.shape[1], weights.ravel(order="F")))], 1), dim, weights.shape[1])
    product = _times(_blocks(rows, dim), block, 1).toIndexedRowMatrix()
    # The rows as a DataFrame of the virtual machine; ``rows`` would pass them through Python.
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select(F.col("index").alias("idx"), vector_to_array("vector").alias("whitened"))


def identity_error(projected: DataFrame) -> float:
    """Largest absolute entry of the covariance of ``whitened``, centred, minus the identity."""
    def sums(of: DataFrame, centre: np.ndarray | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, 0.0
            for batch in batches:
                if batch.num_rows:
                    y = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                    n += len(y)
                    total = total + (y.sum(axis=0) if centre is None
                                     else ((y - centre).T @ (y - centre)).ravel())
            if n:
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array(range(len(total)), pa.int32()), "total": total,
                    "n": pa.array([n] * len(total), pa.int64())})
        return (of.mapInArrow(released(run), "at int, total double, n bigint")
                .groupBy("at").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("at"))

    whitened = projected.select("whitened")
    mean = np.array([r["mean"] for r in sums(whitened, None).collect()])
    found = np.array([r["mean"] for r in sums(whitened, mean).collect()])
    return float(np.abs(found.reshape(len(mean), -1) - np.eye(len(mean))).max())


def whiten(rows: DataFrame, vector: Column, vec_id: str = "vec_id", components: int = 16,
           carry: Sequence[str] = ()) -> tuple[DataFrame, Fit | None, float | None]:
    """``id``, ``deviation``, ``whitened`` and ``carried`` of every row that takes part; the fit;
    and how far the covariance of the whitened distinct vectors is from the identity.

    ``vector`` is a column of arrays of long.
    """
    spark = rows.sparkSession
    kept = rows.select(F.col(vec_id).alias("id"), vector.alias("x"),
                       carried(rows, carry).alias("carried")).where(F.col("x").isNotNull())
    kept = staged(kept, "vectors")
    distinct = staged(kept.select("x").distinct(), "distinct")
    model = fit(distinct)
    schema = fields(kept, ["id"], f"deviation {EXACT}, whitened array<double>")
    schema = schema.add(kept.schema["carried"])
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema), model, None
    dim = len(model.sums)
    indexed = _indexed(kept.where(F.size("x") == dim), "indexed")
    centred = _centred(indexed, model.n, model.sums, ["idx", "id", "carried", "x"])
    found = staged(centred.drop("row").join(project(centred, model, components), "idx"), "white")
    # The first row of each distinct vector stands for it.
    firsts = found.groupBy("x").agg(F.min("idx").alias("idx")).select("idx")
    error = identity_error(found.join(firsts, "idx"))
    return found.select("id", "deviation", "whitened", "carried"), model, error
