"""Layered assets: ingestion, staging and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmill.operators.aggregates import daily_report
from tripmill.operators.dedupe import keep_first
from tripmill.operators.filters import half_open
from tripmill.operators.joins import lookup_join

SAME_TRIP = ["pickup_datetime", "dropoff_datetime", "pickup_location_id",
             "dropoff_location_id", "fare_amount"]


def staged_trips(ingested: DataFrame, payment_names: DataFrame, start: str, end: str,
                 date_col: str | None = None) -> DataFrame:
    """Trips of a window with payment name, one per composite key.

    Only the needed columns enter the shuffle and the label is joined to the rows that stay.
    Ties on the key are settled by taxi type and payment code.
    """
    window = half_open(ingested, "pickup_datetime", start, end, date_col)
    slim = window.select(
        "pickup_datetime", "dropoff_datetime", F.col("pulocation_id").alias("pickup_location_id"),
        F.col("dolocation_id").alias("dropoff_location_id"), "fare_amount", "taxi_type",
        "payment_type")
    first = keep_first(slim, SAME_TRIP, ["taxi_type", F.asc_nulls_last("payment_type")])
    labelled = lookup_join(first, payment_names,
                           F.col("payment_type") == F.col("payment_type_id"))
    return labelled.select(*SAME_TRIP, "taxi_type", "payment_type_name")


def trips_report(staged: DataFrame, start: str, end: str) -> DataFrame:
    """Trips and fares per date and pickup zone of a window."""
    return daily_report(half_open(staged, "pickup_datetime", start, end))
