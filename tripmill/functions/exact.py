"""Sums and means that do not depend on row order.

Adding doubles in a different order changes the last digits, so a report would change with the
number of tasks. These functions add whole ten-thousandths as longs, and what a value has beyond
them as doubles. Amounts of up to four decimals leave nothing beyond, so their sums are exact; finer
values lose nothing, and NaN, infinities and values too large for the unit take part as in a plain
sum. That needs no decimal objects, keeps the fast hash map, and overflow raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE = 10_000

# Beyond this many units a double no longer holds every whole number.
MOST_UNITS = float(1 << 53)


def _parts(col: Column | str, scale: int) -> tuple[Column, Column]:
    """Whole units of a value, null where it has none, and the rest of it."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    units = F.rint(value * F.lit(float(scale)))
    fits = F.abs(units) <= F.lit(MOST_UNITS)  # NaN is larger than any number
    return (F.when(fits, units.cast("bigint")),
            F.when(fits, value - units / F.lit(float(scale))).otherwise(value))


def exact_sum(col: Column | str, scale: int = SCALE) -> Column:
    """Sum of a double column, exact in units of ``1/scale``, as double."""
    units, rest = _parts(col, scale)
    return F.coalesce(F.sum(units), F.lit(0)) / F.lit(float(scale)) + F.sum(rest)


def exact_avg(col: Column | str, scale: int = SCALE) -> Column:
    """Mean over non-null values, computed from the exact sum."""
    return exact_sum(col, scale) / F.count(col)


def exact_sum_sql(col: str, scale: int = SCALE) -> str:
    """``exact_sum`` as text of Spark SQL."""
    units = f"rint(CAST({col} AS double) * {float(scale)}D)"
    fits = f"abs({units}) <= {MOST_UNITS!r}D"
    return (f"coalesce(sum(CASE WHEN {fits} THEN CAST({units} AS bigint) END), 0) / {float(scale)}D"
            f" + sum(CASE WHEN {fits} THEN {col} - {units} / {float(scale)}D ELSE {col} END)")
