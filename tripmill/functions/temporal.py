"""Date and time expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def month_of(ts: Column | str) -> Column:
    """First instant of the month."""
    return F.date_trunc("month", ts)


def hour_of(ts: Column | str) -> Column:
    """First instant of the hour."""
    return F.date_trunc("hour", ts)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from start to end: 10:00:59 to 10:01:01 is one."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.floor(F.unix_seconds(end) / 60) - F.floor(F.unix_seconds(start) / 60)


def from_epoch_ms(col: Column | str) -> Column:
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def to_epoch_ms(col: Column | str) -> Column:
    return F.unix_millis(F.col(col) if isinstance(col, str) else col)


def parse_timestamp(text: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp; unreadable text becomes null."""
    if pattern is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(pattern))


def month_label(col: Column | str) -> Column:
    """``yyyy-MM``."""
    return F.date_format(col, "yyyy-MM")


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month starts from the month of ``first`` to the month of ``last``."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"),
                      F.expr("interval 1 month"))


def months(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    """One row per month in a closed range, stepping on month starts."""
    bounds = spark.range(1).select(
        F.lit(str(first)).cast("date").alias("first"), F.lit(str(last)).cast("date").alias("last"))
    return bounds.select(F.explode(month_sequence(F.col("first"), F.col("last"))).alias("month"))


def month_list(first: str | date, last: str | date) -> list[tuple[int, int]]:
    """``(year, month)`` pairs of a closed range, for building file paths."""
    first, last = date.fromisoformat(str(first)), date.fromisoformat(str(last))
    steps = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [(s // 12, s % 12 + 1) for s in steps]
