"""Filters that reach both the partition list and the file statistics."""

from __future__ import annotations

from datetime import timedelta

from typing import Any

from pyspark.sql import DataFrame, functions as F

# Bound used when the target has no rows; leaves room for a lookback.
EARLIEST = "1000-01-01"


def half_open(df: DataFrame, ts: str, start: str, end: str,
              date_col: str | None = None) -> DataFrame:
    """Rows with ``start <= ts < end``.

    ``date_col`` names the column the table is laid out by, which must be the date of ``ts``.
    A closed date range on it is added, so whole partitions are skipped before any file opens.
    """
    lower, upper = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    kept = df.where((F.col(ts) >= lower) & (F.col(ts) < upper))
    if date_col:
        kept = kept.where(F.col(date_col).between(F.to_date(lower), F.to_date(upper)))
    return kept


def date_range(df: DataFrame, ts: str, first: str, last: str,
               date_col: str | None = None) -> DataFrame:
    """Rows whose date lies in a closed range, pruned by ``date_col`` when there is one."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    if date_col:
        return df.where(F.col(date_col).between(low, high))
    return df.where(F.to_date(ts).between(low, high))


def newer_than(source: DataFrame, target: DataFrame, ts: str,
               lookback: timedelta | None = None, date_col: str | None = None) -> DataFrame:
    """Source rows later than the target's newest row; an empty target bounds nothing.

    The bound is a scalar subquery, so the plan has no join and the comparison is pushed to the
    scan. ``lookback`` moves it back to let late rows in again. Rows without ``ts`` are dropped.
    """
    newest = F.coalesce(F.max(ts), F.lit(EARLIEST).cast(source.schema[ts].dataType))
    if lookback:
        newest = F.timestamp_add("SECOND", F.lit(-int(lookback.total_seconds())), newest)
    kept = source.where(F.col(ts) > target.agg(newest).scalar())
    if date_col:
        kept = kept.where(F.col(date_col) >= target.agg(F.to_date(newest)).scalar())
    return kept


def later_than(source: DataFrame, ts: str, newest: Any, lookback: timedelta | None = None,
               date_col: str | None = None) -> DataFrame:
    """Source rows later than a known newest value, moved back by ``lookback``."""
    bound = newest - lookback if lookback else newest
    kept = source.where(F.col(ts) > F.lit(bound))
    return kept.where(F.col(date_col) >= F.to_date(F.lit(bound))) if date_col else kept
