"""Aggregations and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill.catalog.joins import zone_day_sums
from tripmill.catalog.prelude import mean, total
from tripmill.catalog.registry import query
from tripmill.functions.exact import exact_sum_sql
from tripmill.operators import aggregates as agg, filters
from tripmill.operators.aggregates import MONTHLY_MEANS, MONTHLY_SUMS
from tripmill.plans import layers, revenue, star
from tripmill.sources import adapters, files

_MONTHLY = ", ".join([f"{total(c)} AS {n}" for n, c in MONTHLY_SUMS.items()]
                     + [f"{mean(c)} AS {n}" for n, c in MONTHLY_MEANS.items()])

MONTHLY_SQL = f"""
SELECT PULocationID AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
  service_type, {_MONTHLY} FROM trips GROUP BY 1, 2, 3"""


@query("agg_monthly_revenue", MONTHLY_SQL)
def agg_monthly_revenue(spark, d):
    return revenue.monthly(adapters.green(spark, d), adapters.yellow(spark, d))


@query("agg_hourly_revenue", f"""
SELECT date_trunc('hour', lpep_pickup_datetime) AS hour, PULocationID AS zone,
  {total('total_amount')} AS amount, count(*) AS number_records
FROM green WHERE lpep_pickup_datetime >= TIMESTAMP '1998-01-01' GROUP BY 1, 2""")
def agg_hourly_revenue(spark, d):
    return agg.hourly_revenue(adapters.green(spark, d, dated=True), "1998-01-01",
                              "lpep_pickup_datetime", "pickup_date")


@query("agg_count", "SELECT count(*) AS n FROM hvfhv")
def agg_count(spark, d):
    return agg.row_count(adapters.hvfhv(spark, d))


@query("agg_count_filtered", """
SELECT count(*) AS trips FROM yellow
WHERE CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1999-06-01' AND DATE '2000-12-31'
  AND VendorID = 1""")
def agg_count_filtered(spark, d):
    rows = filters.date_range(adapters.yellow(spark, d, dated=True), "tpep_pickup_datetime",
                              "1999-06-01", "2000-12-31", "pickup_date")
    return agg.row_count(rows.where(F.col("VendorID") == 1), "trips")


@query("agg_count_distinct", "SELECT count(DISTINCT dispatching_base_num) AS n FROM hvfhv")
def agg_count_distinct(spark, d):
    return agg.distinct_count(adapters.fhv(spark, d), "dispatching_base_num")


@query("agg_distinct", """
SELECT DISTINCT VendorID FROM yellow
WHERE CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1999-06-01' AND DATE '1999-06-30'""")
def agg_distinct(spark, d):
    return filters.date_range(
        adapters.yellow(spark, d, dated=True), "tpep_pickup_datetime", "1999-06-01",
        "1999-06-30", "pickup_date").select("VendorID").distinct()


@query("agg_group_count", "SELECT service_type, count(*) AS n FROM trips GROUP BY 1")
def agg_group_count(spark, d):
    return agg.group_count(adapters.trips(spark, d), "service_type")


@query("agg_daily_report", f"""
SELECT CAST(pickup_datetime AS DATE) AS date, PULocationID AS pickup_location_id,
  count(*) AS trip_count, {total('fare_amount')} AS total_fare
FROM trips WHERE pickup_datetime >= TIMESTAMP '1996-01-01'
  AND pickup_datetime < TIMESTAMP '2001-01-01' GROUP BY 1, 2""")
def agg_daily_report(spark, d):
    window = filters.half_open(adapters.trips(spark, d, dated=True), "pickup_datetime",
                               "1996-01-01", "2001-01-01", "pickup_date")
    return agg.daily_report(window.withColumnRenamed("PULocationID", "pickup_location_id"))


@query("agg_report_by_type", f"""
SELECT CAST(pickup_datetime AS DATE) AS date, service_type AS taxi_type, payment_type_name,
  count(*) AS trip_count, {total('fare_amount')} AS total_fare
FROM trips t LEFT JOIN payment_names ON t.payment_type = payment_type_id GROUP BY 1, 2, 3""")
def agg_report_by_type(spark, d):
    from tripmill.operators.joins import lookup_join
    trips = adapters.trips(spark, d).withColumnRenamed("service_type", "taxi_type")
    named = lookup_join(trips, files.payment_names(spark),
                        F.col("payment_type") == F.col("payment_type_id"))
    return agg.report_by_type(named)


@query("agg_group_ordinal", f"""
SELECT date_trunc('month', pickup_datetime) AS month, service_type, PULocationID,
  {total('total_amount')} AS amount, count(*) AS n FROM trips GROUP BY 1, 2, 3""")
def agg_group_ordinal(spark, d):
    return spark.sql(f"""
        SELECT date_trunc('month', pickup_datetime) AS month, service_type, PULocationID,
          {exact_sum_sql('total_amount')} AS amount, count(*) AS n
        FROM {{trips}} GROUP BY 1, 2, 3""", trips=adapters.trips(spark, d))


@query("agg_avg_rounded", f"""
SELECT coalesce(brand, 'N/A') AS brand, round({mean('price')}, 2) AS avg_price
FROM products GROUP BY 1 ORDER BY avg_price DESC, brand""")
def agg_avg_rounded(spark, d):
    from tripmill.operators.projections import keep_or_default
    items = adapters.products(spark, d).select(F.explode("products").alias("p")).select("p.*")
    kept = keep_or_default(items, ["brand", "price"])
    return agg.rounded_mean(kept, "brand", "price", "avg_price").orderBy(
        F.desc("avg_price"), "brand")


@query("agg_dim_vendor", """
SELECT DISTINCT VendorID AS vendorid, CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies'
  WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown/Other' END AS vendor_name
FROM trips WHERE VendorID IS NOT NULL""")
def agg_dim_vendor(spark, d):
    return star.dim_vendor(_unioned(spark, d))


@query("agg_sum_by_zone_day", f"""
SELECT Zone AS pickup_zone, {total('total_amount')} AS amount FROM green
JOIN zones ON PULocationID = LocationID
WHERE CAST(lpep_pickup_datetime AS DATE) = DATE '1999-11-18' GROUP BY 1""")
def agg_sum_by_zone_day(spark, d):
    return zone_day_sums(spark, d)


@query("agg_max_scalar", "SELECT max(pickup_datetime) AS newest FROM trips")
def agg_max_scalar(spark, d):
    return adapters.trips(spark, d).agg(F.max("pickup_datetime").alias("newest"))


@query("agg_partition_rows", """
SELECT pickup_date, count(*) AS total_rows FROM trips GROUP BY 1
ORDER BY total_rows DESC, pickup_date""")
def agg_partition_rows(spark, d):
    return agg.partition_rows(adapters.trips(spark, d, dated=True), "pickup_date")


@query("agg_reduce_by_key", f"""
SELECT date_trunc('hour', lpep_pickup_datetime) AS hour, PULocationID AS zone,
  {total('total_amount')} AS revenue, count(*) AS count
FROM green WHERE lpep_pickup_datetime >= TIMESTAMP '1998-01-01' GROUP BY 1, 2""")
def agg_reduce_by_key(spark, d):
    return agg.hourly_revenue(
        adapters.green(spark, d, dated=True), "1998-01-01", "lpep_pickup_datetime",
        "pickup_date").withColumnsRenamed({"amount": "revenue", "number_records": "count"})


@query("agg_row_count_flag", """
SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS has_rows FROM trips""")
def agg_row_count_flag(spark, d):
    return agg.has_rows(adapters.trips(spark, d))


# Models ---------------------------------------------------------------------------------------

def _unioned(spark, d):
    return star.trips_unioned(star.staging(adapters.green(spark, d), "green"),
                              star.staging(adapters.yellow(spark, d), "yellow"))


def _staged(service: str, stamp: str, trip_type: str, ehail: str) -> str:
    money = lambda c: f"CAST({c} AS DECIMAL(18,3)) AS {c}"
    return f"""
  SELECT VendorID AS vendorid, RatecodeID AS rate_code_id, PULocationID AS pickup_locationid,
    DOLocationID AS dropoff_locationid, {stamp}_pickup_datetime AS pickup_datetime,
    {stamp}_dropoff_datetime AS dropoff_datetime, store_and_fwd_flag, passenger_count,
    {money('trip_distance')}, {trip_type} AS trip_type, {money('fare_amount')},
    {money('extra')}, {money('mta_tax')}, {money('tip_amount')}, {money('tolls_amount')},
    CAST({ehail} AS DECIMAL(18,3)) AS ehail_fee, {money('improvement_surcharge')},
    {money('total_amount')}, payment_type,
    CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'Other' END
      AS payment_type_description
  FROM {service} WHERE VendorID IS NOT NULL"""


_STG_GREEN = _staged("green", "lpep", "trip_type", "ehail_fee")
_STG_YELLOW = _staged("yellow", "tpep", "1", "0")
_MODELS = f"""
, unioned AS (
  SELECT *, 'Green' AS service_type FROM ({_STG_GREEN})
  UNION ALL
  SELECT *, 'Yellow' AS service_type FROM ({_STG_YELLOW})
), int_trips AS (
  SELECT md5(concat_ws('-', CAST(vendorid AS VARCHAR), CAST(pickup_datetime AS VARCHAR),
      CAST(dropoff_datetime AS VARCHAR), CAST(pickup_locationid AS VARCHAR),
      CAST(dropoff_locationid AS VARCHAR), service_type)) AS trip_id,
    u.* EXCLUDE (payment_type, payment_type_description),
    coalesce(u.payment_type, 0) AS payment_type,
    coalesce(p.description, 'Unknown') AS payment_type_description
  FROM unioned u LEFT JOIN payments p ON coalesce(u.payment_type, 0) = p.payment_type
  QUALIFY row_number() OVER (
    PARTITION BY vendorid, pickup_datetime, pickup_locationid, service_type
    ORDER BY {', '.join(f'u.{c} NULLS FIRST' for c in star.FIRST_DROPOFF)}) = 1
)"""


@query("mdl_staging", f"""
SELECT *, 'green' AS service FROM ({_STG_GREEN})
UNION ALL SELECT *, 'yellow' AS service FROM ({_STG_YELLOW})""")
def mdl_staging(spark, d):
    green = star.staging(adapters.green(spark, d), "green")
    yellow = star.staging(adapters.yellow(spark, d), "yellow")
    return green.withColumn("service", F.lit("green")).unionByName(
        yellow.withColumn("service", F.lit("yellow")))


@query("mdl_int_trips", _MODELS + " SELECT * FROM int_trips")
def mdl_int_trips(spark, d):
    return star.enriched_trips(_unioned(spark, d), files.payment_descriptions(spark))


@query("mdl_fct_trips", _MODELS + """
SELECT trip_id, vendorid, service_type, rate_code_id, pickup_locationid,
  p.Borough AS pickup_borough, p.Zone AS pickup_zone, dropoff_locationid,
  z.Borough AS dropoff_borough, z.Zone AS dropoff_zone, pickup_datetime, dropoff_datetime,
  store_and_fwd_flag, passenger_count, trip_distance, trip_type,
  date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes, fare_amount,
  extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
  payment_type, payment_type_description
FROM int_trips LEFT JOIN zones p ON pickup_locationid = p.LocationID
LEFT JOIN zones z ON dropoff_locationid = z.LocationID""")
def mdl_fct_trips(spark, d):
    return star.build_fact(adapters.green(spark, d), adapters.yellow(spark, d),
                           files.payment_descriptions(spark), adapters.zones(spark, d))


@query("mdl_asset_staging", """
SELECT pickup_datetime, dropoff_datetime, CAST(PULocationID AS BIGINT) AS pickup_location_id,
  CAST(DOLocationID AS BIGINT) AS dropoff_location_id, fare_amount, service_type AS taxi_type,
  payment_type_name
FROM trips t LEFT JOIN payment_names ON t.payment_type = payment_type_id
WHERE pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '2001-01-01'
QUALIFY row_number() OVER (
  PARTITION BY pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, fare_amount
  ORDER BY service_type, t.payment_type NULLS LAST) = 1""")
def mdl_asset_staging(spark, d):
    return layers.staged_trips(adapters.ingested(spark, d, dated=True),
                               files.payment_names(spark), "1996-01-01", "2001-01-01",
                               "pickup_date")
