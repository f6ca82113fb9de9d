"""Python functions over Arrow batches."""

from __future__ import annotations

from tripmill.catalog.functions import BASE_ID_SQL
from tripmill.catalog.prelude import total
from tripmill.catalog.registry import query
from tripmill.functions.labels import base_id_udf
from tripmill.operators import partitions
from tripmill.sources import adapters
from tripmill.streaming.rides import from_rows


@query("udf_base_id", BASE_ID_SQL)
def udf_base_id(spark, d):
    return adapters.hvfhv(spark, d).select(
        "dispatching_base_num", base_id_udf("dispatching_base_num").alias("base_id"))


@query("udf_predict_partitions", """
SELECT VendorID, lpep_pickup_datetime, PULocationID, DOLocationID, trip_distance,
  trip_distance * 5 AS predicted_duration FROM green""")
def udf_predict_partitions(spark, d):
    trips = adapters.green(spark, d).select(
        "VendorID", "lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance")
    return partitions.predict_batches(trips, partitions.distance_times_five)


@query("rdd_revenue", f"""
SELECT date_trunc('hour', lpep_pickup_datetime) AS hour, PULocationID AS zone,
  {total('total_amount')} AS revenue, CAST(count(*) AS INTEGER) AS count
FROM green WHERE lpep_pickup_datetime >= TIMESTAMP '1998-01-01' GROUP BY 1, 2""")
def rdd_revenue(spark, d):
    return partitions.revenue_by_reduce(adapters.green(spark, d), "1998-01-01",
                                        "lpep_pickup_datetime")


@query("udf_ride_from_row", """
SELECT PULocationID, DOLocationID, trip_distance, total_amount,
  epoch_us(tpep_pickup_datetime) // 1000 AS tpep_pickup_datetime FROM yellow""")
def udf_ride_from_row(spark, d):
    return from_rows(adapters.yellow(spark, d))
