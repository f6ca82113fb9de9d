"""Joins, windows and top-k questions."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tripmill.catalog.prelude import total
from tripmill.catalog.registry import query
from tripmill.functions.exact import exact_sum
from tripmill.operators import dedupe, filters, joins, skew
from tripmill.operators.aggregates import group_count, top
from tripmill.plans import revenue, star
from tripmill.sources import adapters, files

SINCE = "1998-01-01"

_HOURLY = f"""
, green_hours AS (
  SELECT date_trunc('hour', lpep_pickup_datetime) AS hour, PULocationID AS zone,
    {total('total_amount')} AS green_amount, count(*) AS green_number_records
  FROM green WHERE lpep_pickup_datetime >= TIMESTAMP '{SINCE}' GROUP BY 1, 2
), yellow_hours AS (
  SELECT date_trunc('hour', tpep_pickup_datetime) AS hour, PULocationID AS zone,
    {total('total_amount')} AS yellow_amount, count(*) AS yellow_number_records
  FROM yellow WHERE tpep_pickup_datetime >= TIMESTAMP '{SINCE}' GROUP BY 1, 2
)
"""


@query("jn_inner", _HOURLY + """
SELECT hour, green_amount, green_number_records, yellow_amount, yellow_number_records,
  Borough, Zone, service_zone
FROM green_hours FULL JOIN yellow_hours USING (hour, zone)
JOIN zones ON zone = LocationID""".replace("ON zone =", "ON coalesce(green_hours.zone, yellow_hours.zone) =")
       .replace("  Borough, Zone,", "  Borough, zones.Zone,"))
def jn_inner(spark, d):
    return revenue.hourly_with_zones(
        adapters.green(spark, d, dated=True), adapters.yellow(spark, d, dated=True),
        adapters.zones(spark, d), SINCE, "pickup_date")


@query("jn_full_outer_using", _HOURLY + """
SELECT hour, zone, green_amount, green_number_records, yellow_amount, yellow_number_records
FROM green_hours FULL JOIN yellow_hours USING (hour, zone)""")
def jn_full_outer_using(spark, d):
    return revenue.hourly_by_service(
        adapters.green(spark, d, dated=True), adapters.yellow(spark, d, dated=True), SINCE,
        "pickup_date")


@query("jn_left_lookup", """
SELECT pickup_datetime, PULocationID, t.payment_type, payment_type_name FROM trips t
LEFT JOIN payment_names ON t.payment_type = payment_type_id""")
def jn_left_lookup(spark, d):
    trips = adapters.trips(spark, d)
    joined = joins.lookup_join(trips, files.payment_names(spark),
                               F.col("payment_type") == F.col("payment_type_id"))
    return joined.select("pickup_datetime", "PULocationID", "payment_type", "payment_type_name")


@query("jn_left_coalesced_key", """
SELECT pickup_datetime, PULocationID, coalesce(t.payment_type, 0) AS payment_type,
  coalesce(description, 'Unknown') AS payment_type_description
FROM trips t LEFT JOIN payments p ON coalesce(t.payment_type, 0) = p.payment_type""")
def jn_left_coalesced_key(spark, d):
    trips = adapters.trips(spark, d).select(
        "pickup_datetime", "PULocationID",
        F.coalesce("payment_type", F.lit(0)).alias("payment_type"))
    return joins.lookup_join(trips, files.payment_descriptions(spark), ["payment_type"]).select(
        *trips.columns, F.coalesce("description", F.lit("Unknown"))
        .alias("payment_type_description"))


@query("jn_role_playing", """
SELECT pickup_datetime, PULocationID, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
  DOLocationID, z.Borough AS dropoff_borough, z.Zone AS dropoff_zone
FROM trips LEFT JOIN zones p ON PULocationID = p.LocationID
LEFT JOIN zones z ON DOLocationID = z.LocationID""")
def jn_role_playing(spark, d):
    trips = adapters.trips(spark, d).select("pickup_datetime", "PULocationID", "DOLocationID")
    dim = joins.sized(star.dim_zones(adapters.zones(spark, d)))
    both = joins.with_zone(trips, dim, "PULocationID", "pickup")
    return joins.with_zone(both, dim, "DOLocationID", "dropoff")


_BIGGEST_TIP = """
SELECT z.Zone AS dropoff_zone, tip_amount FROM green
JOIN zones p ON PULocationID = p.LocationID JOIN zones z ON DOLocationID = z.LocationID
WHERE p.Zone = 'NATION_7' AND lpep_pickup_datetime >= TIMESTAMP '1999-11-01'
  AND lpep_pickup_datetime < TIMESTAMP '1999-12-01'
ORDER BY tip_amount DESC, dropoff_zone LIMIT 1"""


def _tips_from(spark, d, zone, start, end):
    month = filters.half_open(adapters.green(spark, d, dated=True), "lpep_pickup_datetime",
                              start, end, "pickup_date")
    dim = star.dim_zones(adapters.zones(spark, d))
    picked = joins.with_zone(month, joins.sized(dim.where(F.col("zone") == zone)),
                             "PULocationID", "pickup", "inner")
    return joins.with_zone(picked, joins.sized(dim), "DOLocationID", "dropoff", "inner")


@query("jn_filter_dim_top", _BIGGEST_TIP)
def jn_filter_dim_top(spark, d):
    tips = _tips_from(spark, d, "NATION_7", "1999-11-01", "1999-12-01")
    return top(tips.select("dropoff_zone", "tip_amount"), 1, F.desc("tip_amount"),
               "dropoff_zone")


@query("top_tip_dropoff", _BIGGEST_TIP)
def top_tip_dropoff(spark, d):
    tips = _tips_from(spark, d, "NATION_7", "1999-11-01", "1999-12-01")
    best = tips.groupBy("dropoff_zone").agg(F.max("tip_amount").alias("tip_amount"))
    return top(best, 1, F.desc("tip_amount"), "dropoff_zone")


@query("jn_anti_insert", """
SELECT o_orderkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                  AND l.l_linestatus = 'F')""")
def jn_anti_insert(spark, d):
    source = adapters.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    target = adapters.table(spark, d, "lineitem").where("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return skew.anti_insert(source, target, ["o_orderkey"])


_FIRST_DROPOFF = """
  dropoff_datetime, DOLocationID, total_amount, payment_type NULLS FIRST, tip_amount"""


def _slim_trips(spark, d):
    return adapters.trips(spark, d).select(
        "VendorID", "pickup_datetime", "PULocationID", "service_type", "dropoff_datetime",
        "DOLocationID", "total_amount", "payment_type", "tip_amount", "fare_amount")


@query("win_dedupe_first", f"""
SELECT VendorID, pickup_datetime, PULocationID, service_type, dropoff_datetime, DOLocationID,
  total_amount, payment_type, tip_amount, fare_amount FROM trips
QUALIFY row_number() OVER (PARTITION BY VendorID, pickup_datetime, PULocationID, service_type
  ORDER BY {_FIRST_DROPOFF}, fare_amount) = 1""")
def win_dedupe_first(spark, d):
    return dedupe.keep_first(
        _slim_trips(spark, d), ["pickup_datetime", "PULocationID", "VendorID", "service_type"],
        ["dropoff_datetime", "DOLocationID", "total_amount", "payment_type", "tip_amount",
         "fare_amount"])


@query("win_dedupe_composite", """
SELECT VendorID, pickup_datetime, PULocationID, service_type, dropoff_datetime, DOLocationID,
  total_amount, payment_type, tip_amount, fare_amount FROM trips
QUALIFY row_number() OVER (
  PARTITION BY pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, fare_amount
  ORDER BY service_type, VendorID NULLS FIRST, total_amount, payment_type NULLS FIRST,
    tip_amount) = 1""")
def win_dedupe_composite(spark, d):
    return dedupe.keep_first(
        _slim_trips(spark, d), ["pickup_datetime", "dropoff_datetime", "PULocationID",
                                "DOLocationID", "fare_amount"],
        ["service_type", "VendorID", "total_amount", "payment_type", "tip_amount"])


@query("win_qualify", """
SELECT PULocationID, pickup_datetime, total_amount FROM trips
QUALIFY row_number() OVER (PARTITION BY PULocationID
  ORDER BY total_amount DESC, pickup_datetime, DOLocationID) <= 3""")
def win_qualify(spark, d):
    best = Window.partitionBy("PULocationID").orderBy(
        F.desc("total_amount"), "pickup_datetime", "DOLocationID")
    slim = adapters.trips(spark, d).select(
        "PULocationID", "pickup_datetime", "total_amount", "DOLocationID")
    return dedupe.qualify(slim, F.row_number().over(best) <= 3).drop("DOLocationID")


@query("srt_desc", f"""
SELECT PULocationID, {total('total_amount')} AS amount FROM trips GROUP BY 1
ORDER BY amount DESC, PULocationID""")
def srt_desc(spark, d):
    return adapters.trips(spark, d).groupBy("PULocationID").agg(
        exact_sum("total_amount").alias("amount")).orderBy(F.desc("amount"), "PULocationID")


@query("lim_n", """
SELECT PULocationID, DOLocationID, trip_distance, total_amount, tpep_pickup_datetime FROM yellow
ORDER BY tpep_pickup_datetime, PULocationID, DOLocationID, trip_distance, total_amount LIMIT 1000""")
def lim_n(spark, d):
    names = ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance",
             "total_amount"]
    return top(adapters.yellow(spark, d).select(names), 1000, *names)


@query("top_longest_trip_day", """
SELECT CAST(lpep_pickup_datetime AS DATE) AS pickup_day, max(trip_distance) AS longest FROM green
WHERE trip_distance < 100 GROUP BY 1 ORDER BY longest DESC, pickup_day LIMIT 1""")
def top_longest_trip_day(spark, d):
    days = adapters.green(spark, d, dated=True).where(F.col("trip_distance") < 100).groupBy(
        F.col("pickup_date").alias("pickup_day")).agg(F.max("trip_distance").alias("longest"))
    return top(days, 1, F.desc("longest"), "pickup_day")


@query("top_zone_revenue", f"""
SELECT Zone AS pickup_zone, {total('total_amount')} AS amount FROM green
JOIN zones ON PULocationID = LocationID
WHERE CAST(lpep_pickup_datetime AS DATE) = DATE '1999-11-18'
GROUP BY 1 ORDER BY amount DESC, pickup_zone LIMIT 1""")
def top_zone_revenue(spark, d):
    return top(zone_day_sums(spark, d), 1, F.desc("amount"), "pickup_zone")


def zone_day_sums(spark, d, day="1999-11-18"):
    """Amount per pickup zone of one day; amounts are summed by id before names are joined."""
    one_day = filters.date_range(adapters.green(spark, d, dated=True), "lpep_pickup_datetime",
                                 day, day, "pickup_date")
    sums = one_day.groupBy("PULocationID").agg(exact_sum("total_amount").alias("amount"))
    dim = joins.sized(star.dim_zones(adapters.zones(spark, d)))
    return joins.with_zone(sums, dim, "PULocationID", "pickup", "inner").select(
        "pickup_zone", "amount")


@query("top_payment_types", """
SELECT payment_type_name, count(*) AS trip_count FROM trips t
LEFT JOIN payment_names ON t.payment_type = payment_type_id
GROUP BY 1 ORDER BY trip_count DESC, payment_type_name NULLS FIRST LIMIT 10""")
def top_payment_types(spark, d):
    counts = group_count(adapters.trips(spark, d), "payment_type", name="trip_count")
    named = joins.lookup_join(counts, files.payment_names(spark),
                              F.col("payment_type") == F.col("payment_type_id"))
    merged = named.groupBy("payment_type_name").agg(F.sum("trip_count").alias("trip_count"))
    return top(merged, 10, F.desc("trip_count"), "payment_type_name")
