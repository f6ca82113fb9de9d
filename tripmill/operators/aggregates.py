"""Grouped reports over trips.

Every aggregate combines rows inside each task before the shuffle, so what moves grows with the
number of groups and not with the number of trips, and a hot zone costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.functions.exact import exact_avg, exact_sum
from tripmill.functions.temporal import hour_of, month_of

# Summed columns of the monthly report, in output order.
MONTHLY_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
}
MONTHLY_MEANS = {
    "avg_monthly_passenger_count": "passenger_count",
    "avg_monthly_trip_distance": "trip_distance",
}


def monthly_revenue(trips: DataFrame) -> DataFrame:
    """Eight sums and two means per pickup zone, month and service."""
    sums = [exact_sum(col).alias(name) for name, col in MONTHLY_SUMS.items()]
    means = [exact_avg(col).alias(name) for name, col in MONTHLY_MEANS.items()]
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month_of("pickup_datetime").alias("revenue_month"),
        "service_type").agg(*sums, *means)


def hourly_revenue(trips: DataFrame, since: str, pickup: str = "pickup_datetime",
                   date_col: str | None = None) -> DataFrame:
    """Amount and number of trips per hour and zone, from ``since`` on."""
    kept = trips.where(F.col(pickup) >= F.lit(since).cast("timestamp"))
    if date_col:
        kept = kept.where(F.col(date_col) >= F.lit(since).cast("date"))
    return kept.groupBy(hour_of(pickup).alias("hour"), F.col("PULocationID").alias("zone")).agg(
        exact_sum("total_amount").alias("amount"), F.count(F.lit(1)).alias("number_records"))


def daily_report(trips: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    """Trips and fares per pickup date and zone."""
    return trips.groupBy(F.to_date("pickup_datetime").alias("date"), zone).agg(
        F.count(F.lit(1)).alias("trip_count"), exact_sum("fare_amount").alias("total_fare"))


def report_by_type(trips: DataFrame) -> DataFrame:
    """Trips and fares per pickup date, taxi type and payment type."""
    return trips.groupBy(F.to_date("pickup_datetime").alias("date"), "taxi_type",
                         "payment_type_name").agg(
        F.count(F.lit(1)).alias("trip_count"), exact_sum("fare_amount").alias("total_fare"))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, name: str = "n", approximate: bool = False,
                   error: float = 0.01) -> DataFrame:
    """Distinct values of a column; the approximate form needs no shuffle of the values."""
    count = F.approx_count_distinct(col, error) if approximate else F.count_distinct(col)
    return df.agg(count.alias(name))


def has_rows(df: DataFrame, name: str = "has_rows") -> DataFrame:
    """1 when there is any row, else 0. Reads no further than the first row."""
    return df.limit(1).agg(F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias(name))


def partition_rows(df: DataFrame, partition: str, name: str = "total_rows") -> DataFrame:
    """Rows per partition, largest first."""
    return group_count(df, partition, name=name).orderBy(F.desc(name), partition)


def rounded_mean(df: DataFrame, key: str, value: str, name: str, digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(F.round(exact_avg(value), digits).alias(name))


def top(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a total order: each task keeps ``n``, no full sort."""
    return df.orderBy(*order).limit(n)


def sum_by(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(exact_sum(col).alias(name))
