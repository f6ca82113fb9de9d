"""Exact medians by distributed selection: nothing is sorted as a whole or gathered.

The range that holds the wanted place is cut into equal buckets, one aggregate counts them and notes
the least and greatest value of each, and the search goes on in the bucket of that place. Bounds are
values that occur, so every pass gets closer, and money columns end after two or three. All columns
and both middle places share each pass. The driver holds bounds and counts, never values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 14


@dataclass
class _Search:
    """The value at ``place`` (from 0) of a column lies among the ``low`` to ``high`` ones."""

    column: int
    place: int
    low: float
    high: float


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def medians(rows: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Median of each column; the mean of the middle two of an even number of values.

    Nulls do not count; NaN is greater than any number. A column without a value has none.
    """
    values = rows.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    aggregates = []
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        held = F.when(_finite(v), v)
        aggregates += [F.count(v).alias(f"n{i}"), F.count_if(v == float("-inf")).alias(f"under{i}"),
                       F.count(held).alias(f"finite{i}"), F.min(held).alias(f"low{i}"),
                       F.max(held).alias(f"high{i}"), F.count_if(F.isnan(v)).alias(f"nan{i}")]
    found = values.agg(*aggregates).first()
    places: dict[tuple[int, int], float | None] = {}
    searches = []
    for i in range(len(columns)):
        n = found[f"n{i}"]
        for place in {(n - 1) // 2, n // 2} if n else ():
            inner = place - found[f"under{i}"]
            if inner < 0:
                places[i, place] = float("-inf")
            elif inner >= found[f"finite{i}"]:
                places[i, place] = float("nan" if place >= n - found[f"nan{i}"] else "inf")
            else:
                searches.append((place, _Search(i, inner, found[f"low{i}"], found[f"high{i}"])))
    while searches:
        for place, s in [x for x in searches if x[1].low == x[1].high]:
            places[s.column, place] = s.low
        searches = [x for x in searches if x[1].low != x[1].high]
        if searches:
            _narrow(values, [s for _, s in searches])
    result: dict[str, float | None] = {}
    for i, c in enumerate(columns):
        n = found[f"n{i}"]
        result[c] = (places[i, (n - 1) // 2] + places[i, n // 2]) / 2 if n else None
    return result


def _narrow(values: DataFrame, searches: list[_Search]) -> None:
    """One pass: every search goes on in the bucket that holds its place."""
    def bucket(s: _Search) -> Column:
        v = F.col(f"v{s.column}")
        # Halves, as the distance of two doubles may not be one.
        share = (v / 2 - F.lit(s.low / 2)) / F.lit(s.high / 2 - s.low / 2)
        at = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        inside = _finite(v) & v.between(s.low, s.high)
        return F.when(inside, F.when(v == s.high, F.lit(BUCKETS - 1)).otherwise(at))
    stacked = values.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("search"), bucket(s).alias("bucket"),
                 F.col(f"v{s.column}").alias("v")) for k, s in enumerate(searches)])))
    counted = stacked.where("bucket IS NOT NULL").groupBy("search", "bucket").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    rows = sorted(counted.collect(), key=lambda r: (r["search"], r["bucket"]))
    for k, s in enumerate(searches):
        for r in (r for r in rows if r["search"] == k):
            if s.place < r["n"]:
                s.low, s.high = r["low"], r["high"]
                break
            s.place -= r["n"]
