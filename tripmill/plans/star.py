"""Star schema: staging, enrichment, dimensions and the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmill import schemas
from tripmill.functions.keys import surrogate_key
from tripmill.functions.labels import payment_label, vendor_label
from tripmill.functions.temporal import minutes_between
from tripmill.operators.dedupe import keep_first
from tripmill.operators.joins import lookup_join, sized, with_zone

MONEY = "decimal(18,3)"

# Staging column, raw column and type. Timestamps differ by service, see below.
STAGING = [
    ("vendorid", "VendorID", "int"),
    ("rate_code_id", "RatecodeID", "int"),
    ("pickup_locationid", "PULocationID", "int"),
    ("dropoff_locationid", "DOLocationID", "int"),
    ("pickup_datetime", "pickup_datetime", "timestamp"),
    ("dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", MONEY),
    ("trip_type", "trip_type", "int"),
    ("fare_amount", "fare_amount", MONEY),
    ("extra", "extra", MONEY),
    ("mta_tax", "mta_tax", MONEY),
    ("tip_amount", "tip_amount", MONEY),
    ("tolls_amount", "tolls_amount", MONEY),
    ("ehail_fee", "ehail_fee", MONEY),
    ("improvement_surcharge", "improvement_surcharge", MONEY),
    ("total_amount", "total_amount", MONEY),
    ("payment_type", "payment_type", "int"),
]

# Columns yellow trips lack. They are street hails and pay no hail fee.
YELLOW_DEFAULTS = {"trip_type": 1, "ehail_fee": 0}

TRIP_KEY = ["vendorid", "pickup_datetime", "dropoff_datetime", "pickup_locationid",
            "dropoff_locationid", "service_type"]
# The most selective key comes first: rows are sorted by it before any other is compared.
SAME_TRIP = ["pickup_datetime", "pickup_locationid", "vendorid", "service_type"]
# The first dropoff wins; the rest makes the choice between ties repeatable.
FIRST_DROPOFF = ["dropoff_datetime", "dropoff_locationid", "total_amount", "payment_type",
                 "fare_amount", "tip_amount", "extra", "trip_distance", "passenger_count",
                 "rate_code_id", "store_and_fwd_flag", "tolls_amount", "trip_type"]


def staging(raw: DataFrame, service: str) -> DataFrame:
    """Trips with a vendor, renamed and cast; both services have the same columns."""
    kept = raw.where(F.col("VendorID").isNotNull()).withColumnsRenamed(schemas.COMMON_NAMES)
    if service == "yellow":
        kept = kept.withColumns({c: F.lit(v) for c, v in YELLOW_DEFAULTS.items()})
    return kept.select(
        *[F.col(source).cast(kind).alias(name) for name, source, kind in STAGING],
        payment_label("payment_type").alias("payment_type_description"))


def trips_unioned(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both staged services, matched by column name, tagged ``Green`` and ``Yellow``."""
    return green.withColumn("service_type", F.lit("Green")).unionByName(
        yellow.withColumn("service_type", F.lit("Yellow")))


def enriched_trips(unioned: DataFrame, payments: DataFrame) -> DataFrame:
    """Trips with key and payment label, the first dropoff per vendor, pickup and service.

    Rows are de-duplicated before key and label are added: neither changes which row stays, and
    the shuffle then carries no hash text.
    """
    first = keep_first(unioned, SAME_TRIP, FIRST_DROPOFF)
    dim = payments.select(F.col("payment_type").alias("_code"), F.col("description"))
    code = F.coalesce(F.col("payment_type"), F.lit(0))
    labelled = lookup_join(first, dim, code == F.col("_code"))
    return labelled.select(
        surrogate_key(TRIP_KEY).alias("trip_id"),
        *[c for c in unioned.columns if c not in ("payment_type", "payment_type_description")],
        code.alias("payment_type"),
        F.coalesce("description", F.lit("Unknown")).alias("payment_type_description"))


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"),
                        F.col("Zone").alias("zone"), "service_zone")


def dim_vendor(unioned: DataFrame) -> DataFrame:
    """Vendor ids in use with their names; the ids are made distinct before they are labelled."""
    return unioned.select("vendorid").distinct().select(
        "vendorid", vendor_label("vendorid").alias("vendor_name"))


# Fact columns in output order.
FACT_COLUMNS = (
    "trip_id vendorid service_type rate_code_id pickup_locationid pickup_borough pickup_zone "
    "dropoff_locationid dropoff_borough dropoff_zone pickup_datetime dropoff_datetime "
    "store_and_fwd_flag passenger_count trip_distance trip_type trip_duration_minutes "
    "fare_amount extra mta_tax tip_amount tolls_amount ehail_fee improvement_surcharge "
    "total_amount payment_type payment_type_description").split()


def fact_trips(enriched: DataFrame, zones: DataFrame, known_zones_only: bool = False,
               years: tuple[int, int] | None = None) -> DataFrame:
    """Trip fact with pickup and dropoff zone and the duration in minutes.

    Trips with unknown zones and all years are kept unless the options say otherwise.
    """
    how = "inner" if known_zones_only else "left"
    if years:
        enriched = enriched.where(F.year("pickup_datetime").between(*years))
    dim = sized(dim_zones(zones))
    both = with_zone(enriched, dim, "pickup_locationid", "pickup", how)
    both = with_zone(both, dim, "dropoff_locationid", "dropoff", how)
    return both.withColumn(
        "trip_duration_minutes",
        minutes_between("pickup_datetime", "dropoff_datetime")).select(*FACT_COLUMNS)


def build_fact(green_raw: DataFrame, yellow_raw: DataFrame, payments: DataFrame,
               zones: DataFrame) -> DataFrame:
    """The whole chain from raw trips to the fact, as one plan."""
    unioned = trips_unioned(staging(green_raw, "green"), staging(yellow_raw, "yellow"))
    return fact_trips(enriched_trips(unioned, payments), zones)
