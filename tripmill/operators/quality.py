"""Data checks. Each gives rows of ``check_name, column_name, failures, passed``.

All row-level checks of a table are conditional counts of one aggregate, so the table is read
once for any number of them. Only uniqueness needs a shuffle, of the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


@dataclass(frozen=True)
class RowCheck:
    """A condition on single rows; ``fails`` is true for a bad one."""

    name: str
    column: str
    fails: Column


def not_null(col: str) -> RowCheck:
    return RowCheck("not_null", col, F.col(col).isNull())


def accepted_values(col: str, values: Sequence) -> RowCheck:
    """Value outside the list; null is the business of ``not_null``."""
    return RowCheck("accepted_values", col, ~F.col(col).isin(list(values)))


def positive(col: str) -> RowCheck:
    return RowCheck("positive", col, F.col(col) <= 0)


def non_negative(col: str) -> RowCheck:
    return RowCheck("non_negative", col, F.col(col) < 0)


def row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Any number of row-level checks in one pass."""
    counts = df.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                     F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    return _verdict(counts.select(F.inline(F.array(*rows))))


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Number of keys that occur more than once; keys with a null part are left out."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    repeated = (df.where(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1"))
    return _verdict(repeated.agg(
        F.lit("unique").alias("check_name"), F.lit(",".join(cols)).alias("column_name"),
        F.count(F.lit(1)).alias("failures")))


def custom_query(spark: SparkSession, name: str, query: str, expected,
                 **tables: DataFrame) -> DataFrame:
    """A query giving one value, compared with the expected one; a null value fails."""
    value = spark.sql(query, **tables)
    same = F.col(value.columns[0]).eqNullSafe(F.lit(expected))
    return _verdict(value.select(
        F.lit(name).alias("check_name"), F.lit("").alias("column_name"),
        F.when(same, 0).otherwise(1).cast("bigint").alias("failures")))


def report(df: DataFrame, checks: Sequence[RowCheck],
           unique_keys: Sequence[Sequence[str]] = ()) -> DataFrame:
    """All checks of a table as rows."""
    parts = [row_checks(df, checks)] + [unique(df, *key) for key in unique_keys]
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, head: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Column name, type, non-null count and row count, from one pass.

    With ``head``, also the values of that many first rows as text, one line of them per column, by
    ``order`` or else by all columns. These come from a top-k, which keeps ``head`` rows a task.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    if head:
        top = df.orderBy(*(order or df.columns)).limit(head)
        shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")).alias(f"h{i}")
                 for i, c in enumerate(df.columns)]
        place = F.row_number().over(Window.orderBy(*(order or df.columns))).alias("place")
        top = top.select(place, *shown)
        heads = top.agg(*[F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("place", F.col(f"h{i}").alias("shown")))),
            lambda x: x["shown"]), " | ").alias(f"h{i}") for i in range(len(shown))])
        counts = counts.join(heads)  # one row each
    rows = [F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"),
                     F.col(f"c{i}").alias("non_null"), F.col("n").alias("row_count"),
                     *([F.col(f"h{i}").alias("head")] if head else []))
            for i, (name, kind) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; Parquet counts come from file footers."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _verdict(rows: DataFrame) -> DataFrame:
    return rows.withColumn("passed", F.col("failures") == 0)
