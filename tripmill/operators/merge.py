"""Materialisation strategies as table expressions.

Each function returns the rows the target should hold afterwards. ``tripmill.sinks.tables``
applies them to stored tables and rewrites only the partitions that change.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.operators.dedupe import keep_first
from tripmill.operators.filters import half_open, newer_than
from tripmill.operators.skew import anti_insert


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source)


def append_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append where either side may have columns the other lacks; they are null there."""
    return target.unionByName(source, allowMissingColumns=True)


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str],
             dedupe_source: bool = False,
             order: Sequence[str | Column] = ()) -> DataFrame:
    """Source rows an insert-only merge adds.

    Copies inside the source are all inserted, as a merge with only a not-matched branch does;
    ``dedupe_source`` keeps the first of them in the given order.
    """
    if dedupe_source:
        source = keep_first(source, keys, order or keys)
    return anti_insert(source, target, list(keys))


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                dedupe_source: bool = False,
                order: Sequence[str | Column] = ()) -> DataFrame:
    """Target plus the source rows whose key it does not have."""
    return target.unionByName(
        new_rows(target, source, keys, dedupe_source, order), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] = ()) -> DataFrame:
    """Replace rows whose key the source has, insert the rest.

    ``order`` picks one row per key when the source may hold several.
    """
    if order:
        source = keep_first(source, keys, order)
    kept = anti_insert(target, source, list(keys))
    return kept.unionByName(source, allowMissingColumns=True)


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key the source has, insert every source row."""
    return anti_insert(target, source, list(keys)).unionByName(
        source, allowMissingColumns=True)


def replace_interval(target: DataFrame, source: DataFrame, ts: str, start: str, end: str,
                     date_col: str | None = None) -> DataFrame:
    """Replace the rows with ``start <= ts < end`` by the source rows in that interval."""
    lower, upper = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    outside = target.where((F.col(ts) < lower) | (F.col(ts) >= upper) | F.col(ts).isNull())
    return outside.unionByName(half_open(source, ts, start, end, date_col),
                               allowMissingColumns=True)


def incremental(target: DataFrame, source: DataFrame, ts: str, keys: Sequence[str],
                order: Sequence[str | Column] = (), lookback: timedelta | None = None,
                date_col: str | None = None) -> DataFrame:
    """Upsert of the source rows newer than the target's newest row."""
    return upsert(target, newer_than(source, target, ts, lookback, date_col), keys, order)
