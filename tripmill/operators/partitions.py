"""Python functions applied to Arrow batches of a partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tripmill.functions.exact import MOST_UNITS, SCALE

Batches = Iterator[pd.DataFrame]


def predict_batches(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series],
                    name: str = "predicted_duration") -> DataFrame:
    """Add a double column computed by ``model``, one batch of rows at a time."""
    schema = T.StructType(df.schema.fields + [T.StructField(name, T.DoubleType())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.assign(**{name: model(batch).astype("float64")})

    return df.mapInPandas(run, schema)


def distance_times_five(batch: pd.DataFrame) -> pd.Series:
    """Stand-in model of the scoring example."""
    return batch["trip_distance"] * 5


def revenue_by_reduce(trips: DataFrame, since: str, pickup: str) -> DataFrame:
    """Hourly revenue written as filter, map to a key with (amount, 1), and reduce by key.

    The reduce runs twice: in Python over each batch and in the engine over the batch results,
    so only one row per key and batch leaves the Python worker. Amounts travel as whole
    ten-thousandths and what they have beyond these, which makes the result equal to the declarative
    report to the last digit. Null amounts are left out; one that is NaN makes its sum NaN.
    """
    schema = "hour timestamp, zone int, units bigint, rest double, nans bigint, n bigint"
    start = pd.Timestamp(since)

    def reduce_batches(batches: Batches) -> Batches:
        for batch in batches:
            kept = batch[batch[pickup] >= start]
            amount = kept["total_amount"]
            units = (amount * SCALE).round()
            fits = units.abs() <= MOST_UNITS
            mapped = pd.DataFrame({
                "hour": kept[pickup].dt.floor("h"), "zone": kept["PULocationID"],
                "units": units.where(fits), "rest": (amount - units / SCALE).where(fits, amount),
                "nans": kept["is_nan"].astype("int64"), "n": 1})
            yield (mapped.groupby(["hour", "zone"], dropna=False, sort=False)
                   .sum(min_count=1).reset_index())

    # A pandas column does not tell null from NaN.
    is_nan = F.coalesce(F.isnan("total_amount"), F.lit(False)).alias("is_nan")
    reduced = trips.select(pickup, "PULocationID", "total_amount", is_nan).mapInPandas(
        reduce_batches, schema)
    total = F.coalesce(F.sum("units"), F.lit(0)) / F.lit(float(SCALE)) + F.sum("rest")
    return reduced.groupBy("hour", "zone").agg(
        F.when(F.sum("nans") > 0, F.lit(float("nan"))).otherwise(total).alias("revenue"),
        F.sum("n").cast("int").alias("count"))
