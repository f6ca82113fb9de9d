"""Row keys made from hashed column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: text that stands for null inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def number_text(col: Column | str) -> Column:
    """Shortest text of a double without an exponent: ``12.5``, ``10``, ``0``, ``0.00004``.

    Engines print doubles differently (``1.0E7``), so the text goes through a decimal of 18 places,
    which holds every digit of the shortest text. Doubles that do not fit it keep their own text.
    """
    value = F.col(col) if isinstance(col, str) else col
    exact = value.try_cast("decimal(38,18)")
    digits = F.rtrim(F.rtrim(exact.cast("string"), F.lit("0")), F.lit("."))
    digits = F.when(digits == "0E-18", F.lit("0")).otherwise(digits)
    return F.when(exact.try_cast("double") == value.cast("double"), digits).otherwise(
        value.cast("string"))


def _text(col: Column | str, null: str) -> Column:
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(text, F.lit(null))


def row_hash(cols: Sequence[Column | str]) -> Column:
    """Hex MD5 of the columns' text, joined without a separator; null counts as empty."""
    return F.md5(F.concat(*[_text(c, "") for c in cols]))


def row_hash_bytes(cols: Sequence[Column | str]) -> Column:
    """The same digest as 16 raw bytes."""
    return F.unhex(row_hash(cols))


def surrogate_key(cols: Sequence[Column | str], null: str = NULL_TOKEN) -> Column:
    """Hex MD5 of the columns' text joined by ``-``, with a marker for nulls."""
    return F.md5(F.concat_ws("-", *[_text(c, null) for c in cols]))


def trip_key_7(pickup: str, dropoff: str) -> Column:
    """Row id of a loaded trip from seven fields."""
    return row_hash(["VendorID", pickup, dropoff, "PULocationID", "DOLocationID",
                     number_text("fare_amount"), number_text("trip_distance")])


def trip_key_5(pickup: str, dropoff: str) -> Column:
    """Row id of a loaded trip from five fields; instants carry their zone."""
    return row_hash_bytes(["VendorID", F.concat(F.col(pickup).cast("string"), F.lit("+00")),
                           F.concat(F.col(dropoff).cast("string"), F.lit("+00")),
                           "PULocationID", "DOLocationID"])
