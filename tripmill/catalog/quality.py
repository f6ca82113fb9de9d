"""Data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill.catalog.registry import query
from tripmill.operators import quality
from tripmill.operators.aggregates import group_count
from tripmill.sources import adapters


def _check(name: str, column: str, fails: str, source: str = "trips") -> str:
    return (f"SELECT '{name}' AS check_name, '{column}' AS column_name, "
            f"count(*) FILTER (WHERE {fails}) AS failures, "
            f"count(*) FILTER (WHERE {fails}) = 0 AS passed FROM {source}")


def _unique(columns: str, present: str, source: str) -> str:
    return (f"SELECT 'unique' AS check_name, '{columns}' AS column_name, count(*) AS failures, "
            f"count(*) = 0 AS passed FROM (SELECT 1 FROM {source} WHERE {present} "
            f"GROUP BY {columns} HAVING count(*) > 1)")


@query("dq_not_null", _check("not_null", "VendorID", "VendorID IS NULL") + " UNION ALL "
       + _check("not_null", "pickup_datetime", "pickup_datetime IS NULL"))
def dq_not_null(spark, d):
    return quality.row_checks(adapters.trips(spark, d), [
        quality.not_null("VendorID"), quality.not_null("pickup_datetime")])


@query("dq_unique", _unique("pickup_datetime,PULocationID", "pickup_datetime IS NOT NULL", "trips"))
def dq_unique(spark, d):
    return quality.unique(adapters.trips(spark, d), "pickup_datetime", "PULocationID")


@query("dq_accepted_values", _check("accepted_values", "service_type",
                                    "service_type NOT IN ('green', 'yellow')")
       + " UNION ALL " + _check("accepted_values", "payment_type",
                                "payment_type NOT IN (1, 2, 3, 4)"))
def dq_accepted_values(spark, d):
    return quality.row_checks(adapters.trips(spark, d), [
        quality.accepted_values("service_type", ["green", "yellow"]),
        quality.accepted_values("payment_type", [1, 2, 3, 4])])


_COUNTS = "(SELECT name, count(*) AS player_count FROM players GROUP BY name)"


@query("dq_positive", _check("positive", "player_count", "player_count <= 0", _COUNTS))
def dq_positive(spark, d):
    counts = group_count(adapters.players(spark, d), "name", name="player_count")
    return quality.row_checks(counts, [quality.positive("player_count")])


@query("dq_non_negative", _check("non_negative", "fare_amount", "fare_amount < 0")
       + " UNION ALL " + _check("non_negative", "tip_amount", "tip_amount < 0"))
def dq_non_negative(spark, d):
    return quality.row_checks(adapters.trips(spark, d), [
        quality.non_negative("fare_amount"), quality.non_negative("tip_amount")])


@query("dq_custom_query", """
SELECT 'row_count_greater_than_zero' AS check_name, '' AS column_name,
  CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failures, count(*) > 0 AS passed
FROM trips""")
def dq_custom_query(spark, d):
    return quality.custom_query(
        spark, "row_count_greater_than_zero", "SELECT count(*) > 0 FROM {trips}", True,
        trips=adapters.trips(spark, d))


@query("dq_report", " UNION ALL ".join([
    _check("not_null", "VendorID", "VendorID IS NULL"),
    _check("not_null", "total_amount", "total_amount IS NULL"),
    _check("accepted_values", "service_type", "service_type NOT IN ('green', 'yellow')"),
    _check("positive", "fare_amount", "fare_amount <= 0"),
    _check("non_negative", "tip_amount", "tip_amount < 0"),
    _unique("VendorID,pickup_datetime,PULocationID,service_type", "VendorID IS NOT NULL", "trips"),
]))
def dq_report(spark, d):
    return quality.report(
        adapters.trips(spark, d),
        [quality.not_null("VendorID"), quality.not_null("total_amount"),
         quality.accepted_values("service_type", ["green", "yellow"]),
         quality.positive("fare_amount"), quality.non_negative("tip_amount")],
        [["VendorID", "pickup_datetime", "PULocationID", "service_type"]])


_PROFILED = {
    "VendorID": "int", "pickup_datetime": "timestamp", "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string", "RatecodeID": "int", "PULocationID": "int",
    "DOLocationID": "int", "passenger_count": "int", "trip_distance": "double",
    "fare_amount": "double", "extra": "double", "mta_tax": "double", "tip_amount": "double",
    "tolls_amount": "double", "improvement_surcharge": "double", "total_amount": "double",
    "payment_type": "int", "congestion_surcharge": "double", "service_type": "string"}
_HEAD = 5


@query("dq_profile", f""", first_rows AS (
  SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _PROFILED)}) AS place
  FROM trips QUALIFY place <= {_HEAD})""" + " UNION ALL ".join(
    f"""
SELECT '{c}' AS column_name, '{k}' AS column_type, count({c}) AS non_null, count(*) AS row_count,
  (SELECT coalesce(string_agg(coalesce(CAST({c} AS VARCHAR), 'NULL'), ' | ' ORDER BY place), '')
   FROM first_rows) AS head FROM trips""" for c, k in _PROFILED.items()))
def dq_profile(spark, d):
    return quality.profile(adapters.trips(spark, d).select(*_PROFILED), _HEAD)


_TABLES = ["lineitem", "orders", "events", "customer", "nation"]


@query("dq_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES))
def dq_row_counts(spark, d):
    return quality.row_counts({t: adapters.table(spark, d, t) for t in _TABLES})
