"""Projections, filters, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.registry import query
from tripmill.functions.keys import row_hash
from tripmill.functions.labels import base_id
from tripmill.operators import filters, projections
from tripmill.operators.joins import lookup_join
from tripmill.operators.aggregates import row_count, top
from tripmill.plans import star
from tripmill.sources import adapters

_COMMON = ", ".join(schemas.COMMON_COLUMNS)
_GREEN_COMMON = _COMMON.replace(
    "pickup_datetime, dropoff_datetime",
    "lpep_pickup_datetime AS pickup_datetime, lpep_dropoff_datetime AS dropoff_datetime")
_YELLOW_COMMON = _COMMON.replace(
    "pickup_datetime, dropoff_datetime",
    "tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime")


@query("prj_rename", f"SELECT {_GREEN_COMMON}, ehail_fee, trip_type FROM green")
def prj_rename(spark, d):
    return projections.common_names(adapters.green(spark, d))


@query("prj_common_columns", f"SELECT {_GREEN_COMMON} FROM green")
def prj_common_columns(spark, d):
    green = projections.common_names(adapters.green(spark, d))
    yellow = projections.common_names(adapters.yellow(spark, d))
    return green.select(projections.common_columns(green, yellow))


@query("prj_fixed_columns", f"SELECT {_YELLOW_COMMON} FROM yellow")
def prj_fixed_columns(spark, d):
    return projections.common_names(adapters.yellow(spark, d)).select(schemas.COMMON_COLUMNS)


@query("prj_literal", """
SELECT VendorID, tpep_pickup_datetime, total_amount, 'yellow' AS service_type, 1 AS trip_type,
  0 AS ehail_fee FROM yellow""")
def prj_literal(spark, d):
    return adapters.yellow(spark, d).select(
        "VendorID", "tpep_pickup_datetime", "total_amount",
        F.lit("yellow").alias("service_type"),
        *[F.lit(v).alias(c) for c, v in star.YELLOW_DEFAULTS.items()])


@query("prj_cast", """
SELECT CAST(VendorID AS INTEGER) AS VendorID, CAST(RatecodeID AS INTEGER) AS RatecodeID,
  CAST(PULocationID AS VARCHAR) AS PULocationID,
  CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance,
  CAST(fare_amount AS DECIMAL(18,3)) AS fare_amount,
  CAST(tip_amount AS DECIMAL(18,3)) AS tip_amount,
  CAST(total_amount AS DECIMAL(18,3)) AS total_amount FROM yellow""")
def prj_cast(spark, d):
    kinds = {"VendorID": "int", "RatecodeID": "int", "PULocationID": "string",
             **{c: star.MONEY for c in ("trip_distance", "fare_amount", "tip_amount",
                                        "total_amount")}}
    return adapters.yellow(spark, d).select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])


@query("prj_select_sample", """
SELECT pickup_datetime, dropoff_datetime, PULocationID, DOLocationID FROM hvfhv
ORDER BY 1, 2, 3, 4 LIMIT 10""")
def prj_select_sample(spark, d):
    names = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]
    return top(adapters.hvfhv(spark, d).select(names), 10, *names)


@query("prj_set_columns", """
SELECT md5(coalesce(CAST(VendorID AS VARCHAR), '')
        || coalesce(CAST(lpep_pickup_datetime AS VARCHAR), '')) AS unique_row_id,
  'green_tripdata.csv' AS filename, VendorID, lpep_pickup_datetime, total_amount FROM green""")
def prj_set_columns(spark, d):
    rows = adapters.green(spark, d).select("VendorID", "lpep_pickup_datetime", "total_amount")
    return rows.withColumns({"unique_row_id": row_hash(["VendorID", "lpep_pickup_datetime"]),
                             "filename": F.lit("green_tripdata.csv")})


@query("prj_drop", """
SELECT PULocationID, total_amount, Borough, Zone, service_zone
FROM green JOIN zones ON PULocationID = LocationID""")
def prj_drop(spark, d):
    trips = adapters.green(spark, d).select("PULocationID", "total_amount")
    zones = adapters.zones(spark, d)
    joined = lookup_join(trips, zones, trips["PULocationID"] == zones["LocationID"], "inner")
    return projections.drop_columns(joined, zones["LocationID"])


@query("prj_derived_columns", """
SELECT
  CASE WHEN n % 7 = 0 THEN 's/' WHEN n % 3 = 0 THEN 'a/' ELSE 'e/' END
    || CASE WHEN length(printf('%x', n)) < 3 THEN lpad(printf('%x', n), 3, '0')
            ELSE printf('%x', n) END AS base_id,
  CAST(pickup_datetime AS DATE) AS pickup_date, CAST(dropoff_datetime AS DATE) AS dropoff_date,
  PULocationID, DOLocationID
FROM (SELECT *, CAST(substr(dispatching_base_num, 2) AS INTEGER) AS n FROM hvfhv)""")
def prj_derived_columns(spark, d):
    return adapters.hvfhv(spark, d).withColumns({
        "pickup_date": F.to_date("pickup_datetime"),
        "dropoff_date": F.to_date("dropoff_datetime"),
        "base_id": base_id("dispatching_base_num"),
    }).select("base_id", "pickup_date", "dropoff_date", "PULocationID", "DOLocationID")


@query("prj_default_missing", """
SELECT coalesce(brand, 'N/A') AS brand, price, 'N/A' AS sku FROM products""")
def prj_default_missing(spark, d):
    items = adapters.products(spark, d).select(F.explode("products").alias("p")).select("p.*")
    return projections.keep_or_default(items, ["brand", "price", "sku"])


@query("prj_star_plus", """
SELECT md5(coalesce(CAST(VendorID AS VARCHAR), '')
        || coalesce(CAST(tpep_pickup_datetime AS VARCHAR), '')) AS unique_row_id,
  'yellow_tripdata.csv' AS filename, * FROM yellow""")
def prj_star_plus(spark, d):
    return adapters.yellow(spark, d).select(
        row_hash(["VendorID", "tpep_pickup_datetime"]).alias("unique_row_id"),
        F.lit("yellow_tripdata.csv").alias("filename"), "*")


@query("prj_dim_zones", """
SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zones""")
def prj_dim_zones(spark, d):
    return star.dim_zones(adapters.zones(spark, d))


@query("flt_eq", """
SELECT pickup_datetime, dropoff_datetime, PULocationID, DOLocationID FROM hvfhv
WHERE hvfhs_license_num = 'HV0003'""")
def flt_eq(spark, d):
    return adapters.hvfhv(spark, d).where(F.col("hvfhs_license_num") == "HV0003").select(
        "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID")


@query("flt_ne", """
SELECT passenger_count, trip_distance, PULocationID, DOLocationID, payment_type, fare_amount,
  tolls_amount, tip_amount FROM yellow WHERE fare_amount <> 0""")
def flt_ne(spark, d):
    return adapters.yellow(spark, d).where(F.col("fare_amount") != 0).select(
        "passenger_count", "trip_distance", "PULocationID", "DOLocationID", "payment_type",
        "fare_amount", "tolls_amount", "tip_amount")


@query("flt_ge_ts", """
SELECT lpep_pickup_datetime, PULocationID, total_amount FROM green
WHERE lpep_pickup_datetime >= TIMESTAMP '1998-06-01 12:00:00'""")
def flt_ge_ts(spark, d):
    green = adapters.green(spark, d, dated=True)
    late = green.where((F.col("pickup_date") >= F.lit("1998-06-01").cast("date"))
                       & (F.col("lpep_pickup_datetime") >= F.lit("1998-06-01 12:00:00")
                          .cast("timestamp")))
    return late.select("lpep_pickup_datetime", "PULocationID", "total_amount")


@query("flt_half_open_window", """
SELECT pickup_datetime, PULocationID, total_amount, service_type FROM trips
WHERE pickup_datetime >= TIMESTAMP '1997-01-01 06:00:00'
  AND pickup_datetime < TIMESTAMP '1998-01-01 06:00:00'""")
def flt_half_open_window(spark, d):
    return filters.half_open(
        adapters.trips(spark, d, dated=True), "pickup_datetime", "1997-01-01 06:00:00",
        "1998-01-01 06:00:00", "pickup_date").select(
        "pickup_datetime", "PULocationID", "total_amount", "service_type")


@query("flt_between_dates", """
SELECT VendorID, tpep_pickup_datetime FROM yellow
WHERE CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1999-06-01' AND DATE '1999-06-30'""")
def flt_between_dates(spark, d):
    return filters.date_range(
        adapters.yellow(spark, d, dated=True), "tpep_pickup_datetime", "1999-06-01",
        "1999-06-30", "pickup_date").select("VendorID", "tpep_pickup_datetime")


@query("flt_in", """
SELECT dispatching_base_num, dropoff_datetime FROM hvfhv
WHERE dispatching_base_num IN ('B00003', 'B00007', 'B00009')""")
def flt_in(spark, d):
    return adapters.fhv(spark, d).where(
        F.col("dispatching_base_num").isin("B00003", "B00007", "B00009")).select(
        "dispatching_base_num", "dropoff_datetime")


@query("flt_not_null", "SELECT VendorID, lpep_pickup_datetime FROM green WHERE VendorID IS NOT NULL")
def flt_not_null(spark, d):
    return adapters.green(spark, d).where(F.col("VendorID").isNotNull()).select(
        "VendorID", "lpep_pickup_datetime")


@query("flt_le_count", """
SELECT count(*) AS short_trips FROM green
WHERE lpep_pickup_datetime >= TIMESTAMP '1999-11-01' AND lpep_pickup_datetime < TIMESTAMP '1999-12-01'
  AND trip_distance <= 10""")
def flt_le_count(spark, d):
    month = filters.half_open(adapters.green(spark, d, dated=True), "lpep_pickup_datetime",
                              "1999-11-01", "1999-12-01", "pickup_date")
    return row_count(month.where(F.col("trip_distance") <= 10), "short_trips")


@query("flt_rdd", """
SELECT lpep_pickup_datetime, PULocationID, total_amount FROM green
WHERE lpep_pickup_datetime >= TIMESTAMP '2000-01-01 00:00:00'""")
def flt_rdd(spark, d):
    def not_an_outlier(row):
        return row["lpep_pickup_datetime"] >= F.lit("2000-01-01").cast("timestamp")
    rows = adapters.green(spark, d).select("lpep_pickup_datetime", "PULocationID", "total_amount")
    return rows.where(not_an_outlier(rows))


@query("flt_incremental_max", """
SELECT pickup_datetime, PULocationID, total_amount, service_type FROM trips
WHERE pickup_datetime > (SELECT max(tpep_pickup_datetime) FROM yellow
                         WHERE CAST(tpep_pickup_datetime AS DATE) <= DATE '2000-03-31')""")
def flt_incremental_max(spark, d):
    stored = adapters.yellow(spark, d, dated=True).where(
        F.col("pickup_date") <= F.lit("2000-03-31").cast("date")).select(
        F.col("tpep_pickup_datetime").alias("pickup_datetime"))
    return filters.newer_than(adapters.trips(spark, d, dated=True), stored, "pickup_datetime",
                              date_col="pickup_date").select(
        "pickup_datetime", "PULocationID", "total_amount", "service_type")


@query("set_union_all", f"""
SELECT {_GREEN_COMMON}, 'green' AS service_type FROM green
UNION ALL
SELECT {_YELLOW_COMMON}, 'yellow' AS service_type FROM yellow""")
def set_union_all(spark, d):
    return projections.tagged_union({
        "green": projections.common_names(adapters.green(spark, d)),
        "yellow": projections.common_names(adapters.yellow(spark, d))})


@query("set_union_missing", f"""
SELECT {_GREEN_COMMON}, ehail_fee, trip_type FROM green
UNION ALL
SELECT {_YELLOW_COMMON}, CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER) FROM yellow""")
def set_union_missing(spark, d):
    green = projections.common_names(adapters.green(spark, d))
    yellow = projections.common_names(adapters.yellow(spark, d))
    return green.unionByName(yellow, allowMissingColumns=True)
