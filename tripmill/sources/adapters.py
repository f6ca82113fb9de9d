"""Trip inputs expressed over the given star-schema tables.

The trip files themselves are not available offline. Each function here presents a given table
in the schema of one trip input, so every job downstream runs over whole tables. All of them are
narrow projections: nothing is shuffled and unused columns are pruned from the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripmill import schemas

# Ship dates are midnights and the added seconds stay below one day, so the ship date is the
# pickup date. A filter on this column therefore reaches the scan as a range on ``l_shipdate``.
_PICKUP_DATE = "cast(l_shipdate as date)"
_PICKUP = ("cast(timestampadd(SECOND, cast((l_orderkey * 7 + l_linenumber) % 86400 as int), "
           "l_shipdate) as timestamp)")
_DROPOFF = ("cast(timestampadd(SECOND, cast((l_orderkey * 7 + l_linenumber) % 86400 "
            "+ 60 + (l_partkey * 31) % 5400 as int), l_shipdate) as timestamp)")

# Amounts are formed in whole cents, as longs: exact, and cheap inside generated code. The tax
# rate is in percent, so half a cent of the product is 50.
_FARE = "if(l_orderkey % 97 = 0, 0L, cast(rint(l_extendedprice * 100) as bigint))"
_EXTRA = "cast(rint(l_discount * 100) as bigint) * 10"
_TIP = ("((cast(rint(l_extendedprice * 100) as bigint) * cast(rint(l_tax * 100) as bigint) + 50) "
        "div 100)")
_TOLLS = "if(l_partkey % 10 = 0, 655, 0)"
_CONGESTION = "if(l_suppkey % 2 = 0, 250, null)"

_VALUES = {
    "VendorID": "cast(nullif(l_suppkey % 5, 0) as int)",
    "pickup_datetime": _PICKUP,
    "dropoff_datetime": _DROPOFF,
    "passenger_count": "cast(l_quantity as int) % 7",
    "trip_distance": "l_quantity * l_linenumber / 2",
    "RatecodeID": "cast(l_partkey % 6 + 1 as int)",
    "store_and_fwd_flag": "if(l_returnflag = 'R', 'Y', 'N')",
    "PULocationID": "cast(l_suppkey % 27 as int)",
    "DOLocationID": "cast(l_partkey % 27 as int)",
    "payment_type": "nullif(l_linenumber, 7)",
    "fare_amount": f"{_FARE} / 100",
    "extra": f"{_EXTRA} / 100",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": f"{_TIP} / 100",
    "tolls_amount": f"{_TOLLS} / 100",
    "ehail_fee": "cast(null as double)",
    "improvement_surcharge": "cast(0.3 as double)",
    "total_amount": (f"({_FARE} + {_EXTRA} + 50 + {_TIP} + {_TOLLS} + 30 "
                     f"+ coalesce({_CONGESTION}, 0)) / 100"),
    "trip_type": "cast(l_suppkey % 2 + 1 as int)",
    "congestion_surcharge": f"{_CONGESTION} / 100",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _value(name: str) -> Column:
    return F.expr(_VALUES[schemas.COMMON_NAMES.get(name, name)]).alias(name)


def _project(lines: DataFrame, names: list[str], dated: bool) -> DataFrame:
    extra = [F.expr(_PICKUP_DATE).alias("pickup_date")] if dated else []
    return lines.select(*[_value(n) for n in names], *extra)


def green(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """Green trips, 20 columns; ``dated`` adds the layout column ``pickup_date``."""
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    return _project(lines, schemas.GREEN_COLUMNS, dated)


def yellow(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """Yellow trips, 18 columns; ``dated`` adds the layout column ``pickup_date``."""
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'")
    return _project(lines, schemas.YELLOW_COLUMNS, dated)


def trips(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """Both services in the common columns plus ``service_type``, from a single scan."""
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus in ('O', 'F')")
    service = F.expr("if(l_linestatus = 'O', 'green', 'yellow')").alias("service_type")
    extra = [F.expr(_PICKUP_DATE).alias("pickup_date")] if dated else []
    return lines.select(*[_value(n) for n in schemas.COMMON_COLUMNS], service, *extra)


def ingested(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """Trips as the ingestion layer stores them: both services, snake-case names."""
    both = trips(spark, sf_dir, dated).withColumnsRenamed(
        {**schemas.INGESTED_NAMES, "service_type": "taxi_type"})
    both = both.withColumn("airport_fee", F.lit(None).cast("double"))
    names = schemas.INGESTED.names + (["pickup_date"] if dated else [])
    return both.select(*[
        F.col(n).cast(schemas.INGESTED[n].dataType) if n in schemas.INGESTED.names else F.col(n)
        for n in names])


def hvfhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-volume for-hire trips, 7 columns."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("concat('HV000', l_linenumber % 4 + 2)").alias("hvfhs_license_num"),
        F.expr("concat('B', lpad(l_suppkey, 5, '0'))").alias("dispatching_base_num"),
        _value("pickup_datetime"), _value("dropoff_datetime"),
        _value("PULocationID"), _value("DOLocationID"),
        F.expr("if(l_returnflag = 'A', '1', null)").alias("SR_Flag"))


def fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For-hire trips: base number, dropoff instant and the date the table is laid out by."""
    return hvfhv(spark, sf_dir).select(
        "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
        F.to_date("dropoff_datetime").alias("dropoff_date"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension; ids 25 and 26 of the trips have no row here."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.expr("if(n_nationkey % 2 = 0, 'Yellow Zone', 'Boro Zone')").alias("service_zone"))


_RIDE_START = "cast(date_trunc('second', ts) as timestamp)"
_RIDE_VALUES = {
    "VendorID": "cast(nullif(user_id % 5, 0) as int)",
    "pickup_datetime": _RIDE_START,
    "dropoff_datetime": (f"timestampadd(SECOND, cast(60 + (event_id * 31) % 5400 as int), "
                         f"{_RIDE_START})"),
    "passenger_count": "cast(event_id % 7 as int)",
    "trip_distance": "(event_id % 200) / 10",
    "RatecodeID": "cast(event_id % 6 + 1 as int)",
    "store_and_fwd_flag": "if(event_type = 'error', 'Y', 'N')",
    "PULocationID": "cast(user_id % 27 as int)",
    "DOLocationID": "cast(event_id % 27 as int)",
    "payment_type": "cast(nullif(event_id % 8, 7) as int)",
    "fare_amount": "value",
    "extra": "cast(0.5 as double)",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": "cast(if(event_type = 'purchase', 2.0, 0.0) as double)",
    "tolls_amount": "cast(0.0 as double)",
    "improvement_surcharge": "cast(0.3 as double)",
    "total_amount": ("(cast(rint(value * 100) as bigint) + 130 "
                     "+ if(event_type = 'purchase', 200, 0)) / 100"),
    "congestion_surcharge": "cast(2.5 as double)",
}


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride events with the pickup instant as epoch milliseconds."""
    plain = [F.expr(_RIDE_VALUES[n]).alias(n) for n in
             ("PULocationID", "DOLocationID", "trip_distance")]
    return table(spark, sf_dir, "events").select(
        *plain, F.col("value").alias("total_amount"),
        F.expr("unix_millis(cast(ts as timestamp))").alias("tpep_pickup_datetime"))


def recent_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of yellow trips made from the events, for tables laid out by day."""
    return table(spark, sf_dir, "events").select(*[
        F.expr(_RIDE_VALUES[schemas.COMMON_NAMES.get(n, n)]).alias(n)
        for n in schemas.YELLOW_COLUMNS])


def recent_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same month keyed by trip id, with its pickup date."""
    names = ["VendorID", "PULocationID", "DOLocationID", "pickup_datetime", "dropoff_datetime",
             "fare_amount", "tip_amount", "total_amount"]
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trip_id"),
        *[F.expr(_RIDE_VALUES[n]).alias(n) for n in names],
        F.expr("cast(ts as date)").alias("pickup_date"))


def products(spark: SparkSession, sf_dir: str, per_document: int = 100) -> DataFrame:
    """Documents with a ``products`` array of at most ``per_document`` parts each."""
    part = table(spark, sf_dir, "part").select(
        F.expr(f"p_partkey div {int(per_document)}").alias("page"),
        F.struct(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
            F.expr("if(p_partkey % 11 = 0, null, p_brand)").alias("brand"),
            F.col("p_retailprice").alias("price")).alias("product"))
    return part.groupBy("page").agg(
        F.sort_array(F.collect_list("product")).alias("products")).drop("page")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player names, many of them shared."""
    return table(spark, sf_dir, "customer").select(
        F.expr("concat(c_mktsegment, '-', c_nationkey)").alias("name"))
