"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str],
               order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order.

    The filter on the row number lets the planner keep one row per key inside every task before
    the shuffle, so a key holding a third of all rows still sends one row per task. Give an
    order that is total, or the choice between ties is open. Name the most selective key first:
    the sort compares it before the others.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return qualify(df, F.row_number().over(window) == 1)


def qualify(df: DataFrame, predicate: Column) -> DataFrame:
    """Filter on a window expression without keeping it as a column."""
    return df.withColumn("_qualify", predicate).where("_qualify").drop("_qualify")
