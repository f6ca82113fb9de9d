"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.prelude import mean, number_text
from tripmill.catalog.registry import query
from tripmill.functions import keys, labels, temporal
from tripmill.operators.aggregates import rounded_mean
from tripmill.sinks.files import json_event
from tripmill.sources import adapters
from tripmill.streaming.rides import decode


@query("fn_date_trunc_month", """
SELECT PULocationID, date_trunc('month', pickup_datetime) AS revenue_month FROM trips""")
def fn_date_trunc_month(spark, d):
    return adapters.trips(spark, d).select(
        "PULocationID", temporal.month_of("pickup_datetime").alias("revenue_month"))


@query("fn_date_trunc_hour", """
SELECT PULocationID, date_trunc('hour', pickup_datetime) AS hour FROM trips""")
def fn_date_trunc_hour(spark, d):
    return adapters.trips(spark, d).select(
        "PULocationID", temporal.hour_of("pickup_datetime").alias("hour"))


@query("fn_to_date", """
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, CAST(dropoff_datetime AS DATE) AS dropoff_date
FROM hvfhv""")
def fn_to_date(spark, d):
    return adapters.hvfhv(spark, d).select(
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"))


@query("fn_datediff_minutes", """
SELECT pickup_datetime, dropoff_datetime,
  date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes FROM trips""")
def fn_datediff_minutes(spark, d):
    return adapters.trips(spark, d).select(
        "pickup_datetime", "dropoff_datetime",
        temporal.minutes_between("pickup_datetime", "dropoff_datetime")
        .alias("trip_duration_minutes"))


@query("fn_parse_ts", """
SELECT PULocationID, CASE WHEN VendorID IS NOT NULL THEN pickup_datetime END AS pickup_datetime
FROM trips""")
def fn_parse_ts(spark, d):
    text = F.when(F.col("VendorID").isNull(), "not a time").otherwise(
        F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"))
    return adapters.trips(spark, d).select(
        "PULocationID",
        temporal.parse_timestamp(text, "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"))


@query("fn_epoch_ms_to_ts", """
SELECT PULocationID, tpep_pickup_datetime,
  make_timestamp(tpep_pickup_datetime * 1000) AS event_timestamp FROM rides""")
def fn_epoch_ms_to_ts(spark, d):
    return adapters.rides(spark, d).select(
        "PULocationID", "tpep_pickup_datetime",
        temporal.from_epoch_ms("tpep_pickup_datetime").alias("event_timestamp"))


@query("fn_ts_to_epoch_ms", """
SELECT PULocationID, epoch_ms(tpep_pickup_datetime) AS tpep_pickup_datetime FROM yellow""")
def fn_ts_to_epoch_ms(spark, d):
    return adapters.yellow(spark, d).select(
        "PULocationID",
        temporal.to_epoch_ms("tpep_pickup_datetime").alias("tpep_pickup_datetime"))


@query("fn_month_sequence", """
SELECT CAST(unnest(generate_series(
    (SELECT date_trunc('month', min(l_shipdate)) FROM lineitem),
    (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem), INTERVAL 1 MONTH)) AS DATE)
  AS month""")
def fn_month_sequence(spark, d):
    bounds = adapters.table(spark, d, "lineitem").agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    return bounds.select(F.explode(temporal.month_sequence(
        F.to_date("first"), F.to_date("last"))).alias("month"))


@query("fn_format_month", """
SELECT strftime(pickup_datetime, '%Y-%m') AS month, strftime(pickup_datetime, '%m') AS mm,
  count(*) AS n FROM trips GROUP BY 1, 2""")
def fn_format_month(spark, d):
    return adapters.trips(spark, d).groupBy(
        temporal.month_label("pickup_datetime").alias("month"),
        F.date_format("pickup_datetime", "MM").alias("mm")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_coalesce", """
SELECT coalesce(payment_type, 0) AS payment_type, coalesce(congestion_surcharge, 0.0)
  AS congestion_surcharge FROM trips""")
def fn_coalesce(spark, d):
    return adapters.trips(spark, d).select(
        F.coalesce("payment_type", F.lit(0)).alias("payment_type"),
        F.coalesce("congestion_surcharge", F.lit(0.0)).alias("congestion_surcharge"))


@query("fn_case_payment", """
SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash'
  WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
  ELSE 'Other' END AS payment_type_description FROM trips""")
def fn_case_payment(spark, d):
    return adapters.trips(spark, d).select(
        "payment_type", labels.payment_label("payment_type").alias("payment_type_description"))


@query("fn_case_vendor", """
SELECT VendorID, CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
  WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM trips""")
def fn_case_vendor(spark, d):
    return adapters.trips(spark, d).select(
        "VendorID", labels.vendor_label("VendorID").alias("vendor_name"))


@query("fn_md5_key_7", f"""
SELECT VendorID, md5(concat(VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID,
  DOLocationID, {number_text('fare_amount')}, {number_text('trip_distance')})) AS unique_row_id
FROM yellow""")
def fn_md5_key_7(spark, d):
    return adapters.yellow(spark, d).select(
        "VendorID", keys.trip_key_7("tpep_pickup_datetime", "tpep_dropoff_datetime")
        .alias("unique_row_id"))


@query("fn_md5_key_5", """
SELECT VendorID, upper(md5(concat(VendorID, CAST(lpep_pickup_datetime AS VARCHAR) || '+00',
  CAST(lpep_dropoff_datetime AS VARCHAR) || '+00', PULocationID, DOLocationID)))
  AS unique_row_id_hex, 16 AS n_bytes FROM green""")
def fn_md5_key_5(spark, d):
    key = keys.trip_key_5("lpep_pickup_datetime", "lpep_dropoff_datetime")
    return adapters.green(spark, d).select(
        "VendorID", key.alias("k")).select(
        "VendorID", F.hex("k").alias("unique_row_id_hex"), F.octet_length("k").alias("n_bytes"))


@query("fn_surrogate_key", """
SELECT md5(concat_ws('-', coalesce(CAST(VendorID AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
  CAST(pickup_datetime AS VARCHAR), CAST(dropoff_datetime AS VARCHAR),
  CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR), service_type)) AS trip_id
FROM trips""")
def fn_surrogate_key(spark, d):
    return adapters.trips(spark, d).select(keys.surrogate_key(
        ["VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
         "service_type"]).alias("trip_id"))


@query("fn_concat", """
SELECT concat(VendorID, pickup_datetime, PULocationID, DOLocationID) AS key_text FROM trips""")
def fn_concat(spark, d):
    parts = ["VendorID", "pickup_datetime", "PULocationID", "DOLocationID"]
    return adapters.trips(spark, d).select(F.concat(*[
        F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]).alias("key_text"))


@query("fn_round", f"""
SELECT brand, round({mean('price')}, 2) AS avg_price FROM products GROUP BY brand""")
def fn_round(spark, d):
    items = adapters.products(spark, d).select(F.explode("products").alias("p")).select("p.*")
    return rounded_mean(items, "brand", "price", "avg_price")


@query("fn_arith", """
SELECT trip_distance, trip_distance * 5 AS predicted_duration FROM green""")
def fn_arith(spark, d):
    return adapters.green(spark, d).select(
        "trip_distance", (F.col("trip_distance") * 5).alias("predicted_duration"))


BASE_ID_SQL = """
SELECT dispatching_base_num,
  CASE WHEN n % 7 = 0 THEN 's/' WHEN n % 3 = 0 THEN 'a/' ELSE 'e/' END
    || CASE WHEN length(printf('%x', n)) < 3 THEN lpad(printf('%x', n), 3, '0')
            ELSE printf('%x', n) END AS base_id
FROM (SELECT *, CAST(substr(dispatching_base_num, 2) AS INTEGER) AS n FROM hvfhv)"""


@query("fn_substr_int_mod_hex", BASE_ID_SQL)
def fn_substr_int_mod_hex(spark, d):
    return adapters.hvfhv(spark, d).select(
        "dispatching_base_num", labels.base_id("dispatching_base_num").alias("base_id"))


@query("fn_json_encode", """
SELECT '{"PULocationID":' || CAST(PULocationID AS VARCHAR) || ',"DOLocationID":'
  || CAST(DOLocationID AS VARCHAR) || ',"tpep_pickup_datetime":'
  || CAST(tpep_pickup_datetime AS VARCHAR) || '}' AS value FROM rides""")
def fn_json_encode(spark, d):
    return adapters.rides(spark, d).select(
        json_event(["PULocationID", "DOLocationID", "tpep_pickup_datetime"]).alias("value"))


@query("fn_json_decode", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def fn_json_decode(spark, d):
    return adapters.table(spark, d, "events").select(
        "event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query("src_message_decode", "SELECT * FROM rides")
def src_message_decode(spark, d):
    messages = adapters.rides(spark, d).select(
        F.encode(json_event(schemas.RIDE.names), "UTF-8").alias("value"))
    return messages.select(decode("value").alias("ride")).select("ride.*")


@query("fn_literal_filename", """
SELECT 'lineitem.parquet' AS filename, l_orderkey, l_linenumber FROM lineitem""")
def fn_literal_filename(spark, d):
    return adapters.table(spark, d, "lineitem").select(
        F.col("_metadata.file_name").alias("filename"), "l_orderkey", "l_linenumber")
