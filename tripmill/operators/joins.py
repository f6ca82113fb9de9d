"""Joins of trips to small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A dimension is broadcast only when counting shows it has at most this many rows.
BROADCAST_ROWS = 50_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``max_rows`` rows; stops reading just beyond the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The dimension with a broadcast hint when it is small, unchanged when it is not.

    Without the hint the planner shuffles both sides and splits skewed keys at run time.
    """
    return F.broadcast(dim) if is_small(dim, max_rows) else dim


def lookup_join(facts: DataFrame, dim: DataFrame, on: Column | str | list[str],
                how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join facts to a dimension whose size is checked before it may be broadcast."""
    return facts.join(sized(dim, max_rows), on, how)


def with_zone(facts: DataFrame, zones: DataFrame, key: str, role: str,
              how: str = "left") -> DataFrame:
    """Add ``<role>_borough`` and ``<role>_zone`` for the zone in ``key``.

    ``zones`` has columns ``location_id, borough, zone``. Pass it through ``sized`` first when
    several roles use it, so that its size is checked once.
    """
    dim = zones.select(F.col("location_id").alias(f"_{role}_id"),
                       F.col("borough").alias(f"{role}_borough"),
                       F.col("zone").alias(f"{role}_zone"))
    return facts.join(dim, F.col(key) == F.col(f"_{role}_id"), how).drop(f"_{role}_id")


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on equally named keys, which appear once. Aggregate both sides first."""
    return left.join(right, keys, "full_outer")
