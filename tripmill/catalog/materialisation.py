"""Materialisation strategies, each run on a stored table and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.prelude import number_text, total
from tripmill.catalog.registry import query
from tripmill.catalog.sources import csv_of
from tripmill.functions.keys import surrogate_key
from tripmill.operators.aggregates import daily_report
from tripmill.plans import loads
from tripmill.session import table_name, workspace
from tripmill.sinks import tables
from tripmill.sources import adapters

_COLUMNS = """trip_id, VendorID, PULocationID, DOLocationID, pickup_datetime, dropoff_datetime,
  fare_amount, tip_amount, total_amount, pickup_date"""
_RAISED = _COLUMNS.replace("total_amount", "total_amount + 1 AS total_amount")
_REPORT = f"""
SELECT pickup_date AS date, PULocationID, count(*) AS trip_count,
  {total('fare_amount')} AS total_fare FROM recent_trips GROUP BY 1, 2"""

EARLY = "pickup_date <= date'2024-01-20'"
AFTER = "pickup_date > date'2024-01-20'"
LATE = "pickup_date >= date'2024-01-15'"


def _stored(spark, rows, label):
    """The rows as a table partitioned by pickup date; returns its name."""
    name = table_name(label)
    tables.create_partitioned(rows.drop("pickup_date"), name, workspace(spark, label),
                              "pickup_datetime")
    return name


def _raised(rows):
    return rows.withColumn("total_amount", F.col("total_amount") + 1)


def _report(rows):
    return daily_report(rows, "PULocationID")


@query("mat_view", _REPORT)
def mat_view(spark, d):
    name = table_name("daily_view")
    _report(adapters.recent_trips(spark, d)).createOrReplaceTempView(name)
    return spark.table(name)


@query("mat_table", _REPORT)
def mat_table(spark, d):
    trips, name = adapters.recent_trips(spark, d), table_name("daily")
    tables.create_as(_report(trips.where(EARLY)), name, workspace(spark, "daily"))
    tables.swap(_report(trips), name)
    return spark.table(name)


@query("mat_append", f"SELECT {_COLUMNS} FROM recent_trips")
def mat_append(spark, d):
    trips = adapters.recent_trips(spark, d)
    name = _stored(spark, trips.where(EARLY), "appended")
    tables.append_rows(trips.where(AFTER), name)
    return spark.table(name)


@query("mrg_upsert", f"""
SELECT {_COLUMNS} FROM recent_trips WHERE pickup_date < DATE '2024-01-15'
UNION ALL SELECT {_RAISED} FROM recent_trips WHERE pickup_date >= DATE '2024-01-15'""")
def mrg_upsert(spark, d):
    trips = adapters.recent_trips(spark, d)
    name = _stored(spark, trips.where(EARLY), "upserted")
    for _ in range(2):
        tables.upsert(_raised(trips.where(LATE)), name, ["trip_id"], "pickup_date",
                      order=["pickup_datetime", "total_amount"])
    return spark.table(name)


@query("mat_time_interval", f"""
SELECT {_COLUMNS} FROM recent_trips
WHERE NOT (pickup_datetime >= TIMESTAMP '2024-01-10 12:00:00'
           AND pickup_datetime < TIMESTAMP '2024-01-20 06:00:00')
UNION ALL
SELECT {_RAISED} FROM recent_trips
WHERE pickup_datetime >= TIMESTAMP '2024-01-10 12:00:00'
  AND pickup_datetime < TIMESTAMP '2024-01-20 06:00:00' AND pickup_date <> DATE '2024-01-15'""")
def mat_time_interval(spark, d):
    """The new rows lack one day, whose partition must disappear."""
    trips = adapters.recent_trips(spark, d)
    name = _stored(spark, trips, "interval")
    fresh = _raised(trips.where(F.col("pickup_date") != F.lit("2024-01-15").cast("date")))
    for _ in range(2):
        tables.replace_interval(fresh, name, "pickup_datetime", "2024-01-10 12:00:00",
                                "2024-01-20 06:00:00", "pickup_date")
    return spark.table(name)


@query("mat_delete_insert", f"""
SELECT {_COLUMNS} FROM recent_trips WHERE trip_id % 3 <> 0
UNION ALL SELECT {_RAISED} FROM recent_trips WHERE trip_id % 3 = 0
UNION ALL SELECT {_RAISED} FROM recent_trips WHERE trip_id % 3 = 0""")
def mat_delete_insert(spark, d):
    trips = adapters.recent_trips(spark, d)
    name = _stored(spark, trips, "delete_insert")
    third = _raised(trips.where("trip_id % 3 = 0"))
    tables.delete_insert(third.unionByName(third), name, ["trip_id"], "pickup_date",
                         key_fixes_partition=True)
    return spark.table(name)


_KEYED = """
, keyed AS (
  SELECT md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS row_key,
    l_orderkey, l_linenumber, l_quantity, l_linestatus FROM lineitem
)"""


@query("mrg_insert_only", _KEYED + """
SELECT * FROM keyed WHERE l_linestatus = 'F'
UNION ALL SELECT * FROM keyed s WHERE l_linestatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM keyed t WHERE t.l_linestatus = 'F' AND t.row_key = s.row_key)""")
def mrg_insert_only(spark, d):
    rows = adapters.table(spark, d, "lineitem").select(
        surrogate_key(["l_orderkey", "l_linenumber"]).alias("row_key"), "l_orderkey",
        "l_linenumber", "l_quantity", "l_linestatus")
    name = table_name("insert_only")
    tables.create_as(rows.where("l_linestatus = 'F'"), name, workspace(spark, "insert-only"))
    for _ in range(2):
        tables.insert_new(rows.where("l_linestatus = 'O'"), name, ["row_key"])
    return spark.table(name)


@query("mat_incremental_fact", f"""
, stored AS (SELECT * FROM recent_trips WHERE pickup_date <= DATE '2024-01-20')
SELECT {_COLUMNS} FROM stored
UNION ALL SELECT {_RAISED} FROM recent_trips
WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM stored)""")
def mat_incremental_fact(spark, d):
    trips = adapters.recent_trips(spark, d)
    name = table_name("fact")
    tables.create_if_absent(spark, name, trips.drop("pickup_date").schema,
                            workspace(spark, "fact"), [trips.schema["pickup_date"]])
    for rows in (trips.where(EARLY), _raised(trips), _raised(trips)):
        tables.incremental(rows, name, "pickup_datetime", ["trip_id"], "pickup_date",
                           order=["pickup_datetime", "total_amount"], key_fixes_partition=True)
    return spark.table(name)


@query("mat_schema_append", """
SELECT trip_id, pickup_datetime, total_amount,
  CASE WHEN pickup_date > DATE '2024-01-20' THEN tip_amount END AS tip_amount FROM recent_trips""")
def mat_schema_append(spark, d):
    trips = adapters.recent_trips(spark, d)
    name = table_name("widened")
    tables.create_as(trips.where(EARLY).select("trip_id", "pickup_datetime", "total_amount"),
                     name, workspace(spark, "widened"))
    wider = trips.where(AFTER).select("trip_id", "pickup_datetime", "total_amount", "tip_amount")
    tables.add_columns(wider, name)
    tables.append_rows(wider, name)
    return spark.table(name)


@query("mat_full_refresh", _REPORT)
def mat_full_refresh(spark, d):
    """Both layers truncated and rebuilt, the report from the refreshed lower layer."""
    trips = adapters.recent_trips(spark, d)
    staging, report = table_name("staging"), table_name("report")
    tables.create_as(trips.where(EARLY), staging, workspace(spark, "staging"))
    tables.create_as(_report(spark.table(staging)), report, workspace(spark, "report"))
    tables.swap(trips, staging)
    tables.swap(_report(spark.table(staging)), report)
    return spark.table(report)


@query("mat_backfill", f"SELECT {_RAISED} FROM recent_trips")
def mat_backfill(spark, d):
    """One job over the whole range, into a table that holds part of it with old amounts."""
    trips = adapters.recent_trips(spark, d)
    name = _stored(spark, trips.where(EARLY), "backfilled")
    tables.replace_interval(_raised(trips), name, "pickup_datetime", "2024-01-01 00:00:00",
                            "2024-02-01 00:00:00", "pickup_date")
    return spark.table(name)


_LOADED = f"""
, staged AS (
  SELECT md5(concat(VendorID, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID,
      {number_text('fare_amount')}, {number_text('trip_distance')})) AS unique_row_id,
    CAST(VendorID AS VARCHAR) AS VendorID, pickup_datetime AS tpep_pickup_datetime,
    dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance,
    CAST(RatecodeID AS VARCHAR) AS RatecodeID, store_and_fwd_flag,
    CAST(PULocationID AS VARCHAR) AS PULocationID, CAST(DOLocationID AS VARCHAR) AS DOLocationID,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, pickup_date FROM recent
), first_file AS (SELECT 'part_1.csv' AS filename, * FROM staged WHERE pickup_date <= DATE '2024-01-15')
SELECT * FROM first_file
UNION ALL SELECT 'all.csv', * FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM first_file f WHERE f.unique_row_id = s.unique_row_id)"""


@query("stg_trip_load", _LOADED)
def stg_trip_load(spark, d):
    """Part of a month, then the whole month twice; rows already loaded are not added again."""
    rows = adapters.recent_yellow(spark, d)
    part = csv_of(spark, rows.where("cast(tpep_pickup_datetime as date) <= '2024-01-15'"), "part")
    whole = csv_of(spark, rows, "whole")
    trips, staging = table_name("yellow_tripdata"), table_name("yellow_staging")
    loads.create_tables(spark, trips, staging, "yellow", workspace(spark, "trips"),
                        workspace(spark, "staging"))
    for path, filename in ((part, "part_1.csv"), (whole, "all.csv"), (whole, "again.csv")):
        loads.load_file(spark, path, trips, staging, "yellow", filename)
    return spark.table(trips)
