"""Small helpers shared by the operators: staged frames, Arrow batches, ASCII lower case."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripmill.session import ensure_session, shared_root, workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Rows and bytes of text that pass between Spark and a Python worker at a time. Whole documents
# travel here, so batches of the default size would fill a small executor.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
              "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}

SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for key, value in BATCH_CONF.items():
        ensure_session(spark).conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder; keeps partitions and the order of rows in them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def carried(df: DataFrame, columns: Sequence[str]) -> Column:
    """Columns an operator only passes on, as one struct, so that names cannot clash."""
    return F.struct(*[df[c] for c in columns]) if columns else F.struct(F.lit(0).alias("none"))


def fields(df: DataFrame, names: Sequence[str], more: str = "") -> T.StructType:
    """Some fields of a frame, then those of a DDL text."""
    return T.StructType([df.schema[n] for n in names]
                        + (T.StructType.fromDDL(more).fields if more else []))


def released(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` over a partition; then Arrow's pool gives the memory of freed buffers back.

    Python workers are reused for later tasks and stages, and the pool would keep the largest
    batches a worker ever held for the rest of the session.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str | T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(released(run), schema)


def batch_of(**columns: pa.Array | Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def in_slices(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``most``; a larger item stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))
