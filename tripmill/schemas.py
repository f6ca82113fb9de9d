"""Declared schemas and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _DBL, _STR, _TS = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType())

# Type and meaning of every raw trip column.
COLUMNS: dict[str, tuple[T.DataType, str]] = {
    "VendorID": (_INT, "provider of the record"),
    "lpep_pickup_datetime": (_TS, "meter switched on (green)"),
    "lpep_dropoff_datetime": (_TS, "meter switched off (green)"),
    "tpep_pickup_datetime": (_TS, "meter switched on (yellow)"),
    "tpep_dropoff_datetime": (_TS, "meter switched off (yellow)"),
    "pickup_datetime": (_TS, "meter switched on"),
    "dropoff_datetime": (_TS, "meter switched off"),
    "store_and_fwd_flag": (_STR, "Y when the record was held in the vehicle before upload"),
    "RatecodeID": (_INT, "rate code at the end of the trip"),
    "PULocationID": (_INT, "zone of the pickup"),
    "DOLocationID": (_INT, "zone of the dropoff"),
    "passenger_count": (_INT, "passengers, entered by the driver"),
    "trip_distance": (_DBL, "miles on the meter"),
    "fare_amount": (_DBL, "time and distance fare"),
    "extra": (_DBL, "extras and surcharges"),
    "mta_tax": (_DBL, "metered-rate tax"),
    "tip_amount": (_DBL, "card tips"),
    "tolls_amount": (_DBL, "tolls paid during the trip"),
    "ehail_fee": (_DBL, "electronic hail fee"),
    "improvement_surcharge": (_DBL, "surcharge at flag drop"),
    "total_amount": (_DBL, "total charged, without cash tips"),
    "payment_type": (_INT, "payment code"),
    "trip_type": (_INT, "1 street hail, 2 dispatch"),
    "congestion_surcharge": (_DBL, "surcharge for congested zones"),
    "hvfhs_license_num": (_STR, "licence of the high-volume base"),
    "dispatching_base_num": (_STR, "base that dispatched the trip"),
    "SR_Flag": (_STR, "shared-ride flag"),
}

# Column order of the published trip files.
GREEN_COLUMNS = (
    "VendorID lpep_pickup_datetime lpep_dropoff_datetime store_and_fwd_flag RatecodeID "
    "PULocationID DOLocationID passenger_count trip_distance fare_amount extra mta_tax "
    "tip_amount tolls_amount ehail_fee improvement_surcharge total_amount payment_type "
    "trip_type congestion_surcharge").split()
YELLOW_COLUMNS = (
    "VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance "
    "RatecodeID store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra "
    "mta_tax tip_amount tolls_amount improvement_surcharge total_amount "
    "congestion_surcharge").split()
COMMON_COLUMNS = (
    "VendorID pickup_datetime dropoff_datetime store_and_fwd_flag RatecodeID PULocationID "
    "DOLocationID passenger_count trip_distance fare_amount extra mta_tax tip_amount "
    "tolls_amount improvement_surcharge total_amount payment_type "
    "congestion_surcharge").split()
HVFHV_COLUMNS = (
    "hvfhs_license_num dispatching_base_num pickup_datetime dropoff_datetime PULocationID "
    "DOLocationID SR_Flag").split()


def _schema(names: list[str], **override: T.DataType) -> T.StructType:
    fields = []
    for name in names:
        data_type, comment = COLUMNS[name]
        fields.append(T.StructField(name, override.get(name, data_type), True,
                                    {"comment": comment}))
    return T.StructType(fields)


GREEN = _schema(GREEN_COLUMNS)
YELLOW = _schema(YELLOW_COLUMNS)
HVFHV = _schema(HVFHV_COLUMNS)
RAW = {"green": GREEN, "yellow": YELLOW}


def loaded(service: str) -> T.StructType:
    """Raw columns of a service with ids kept as text, preceded by row id and file name."""
    ids = {c: _STR for c in ("VendorID", "RatecodeID", "PULocationID", "DOLocationID")}
    head = [
        T.StructField("unique_row_id", _STR, True, {"comment": "hash of the trip's own fields"}),
        T.StructField("filename", _STR, True, {"comment": "file the row came from"}),
    ]
    return T.StructType(head + _schema(RAW[service].names, **ids).fields)


ZONES = T.StructType([
    T.StructField("LocationID", _INT), T.StructField("Borough", _STR),
    T.StructField("Zone", _STR), T.StructField("service_zone", _STR)])

PAYMENT_LOOKUP = T.StructType([
    T.StructField("payment_type", _INT), T.StructField("description", _STR)])
PAYMENT_NAMES = T.StructType([
    T.StructField("payment_type_id", _INT), T.StructField("payment_type_name", _STR)])

RIDE = T.StructType([
    T.StructField("PULocationID", _INT), T.StructField("DOLocationID", _INT),
    T.StructField("trip_distance", _DBL), T.StructField("total_amount", _DBL),
    T.StructField("tpep_pickup_datetime", _LONG, True, {"comment": "epoch milliseconds"})])

INGESTED = T.StructType([
    T.StructField("pickup_datetime", _TS), T.StructField("dropoff_datetime", _TS),
    T.StructField("passenger_count", _LONG), T.StructField("trip_distance", _DBL),
    T.StructField("fare_amount", _DBL), T.StructField("extra", _DBL),
    T.StructField("mta_tax", _DBL), T.StructField("tip_amount", _DBL),
    T.StructField("tolls_amount", _DBL), T.StructField("improvement_surcharge", _DBL),
    T.StructField("total_amount", _DBL), T.StructField("payment_type", _LONG),
    T.StructField("congestion_surcharge", _DBL), T.StructField("airport_fee", _DBL),
    T.StructField("store_and_fwd_flag", _STR), T.StructField("ratecode_id", _LONG),
    T.StructField("pulocation_id", _LONG), T.StructField("dolocation_id", _LONG),
    T.StructField("taxi_type", _STR)])

# Payment code labels of the two lookups, and vendor names. Vendor code 3 has none.
PAYMENT_DESCRIPTIONS = {
    0: "Unknown", 1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute",
    5: "Unknown", 6: "Voided trip"}
PAYMENT_TYPE_NAMES = {
    0: "flex_fare", 1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute",
    5: "unknown", 6: "voided_trip"}
PAYMENT_CASE_LABELS = {
    1: "Credit Card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown",
    6: "Voided trip"}
VENDOR_NAMES = {
    1: "Creative Mobile Technologies", 2: "VeriFone Inc.", 4: "Unknown/Other"}

# Common names for the service-specific columns.
COMMON_NAMES = {
    "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime",
    "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}
INGESTED_NAMES = {
    **COMMON_NAMES, "PULocationID": "pulocation_id", "DOLocationID": "dolocation_id",
    "RatecodeID": "ratecode_id", "Airport_fee": "airport_fee"}
PICKUP = {"green": "lpep_pickup_datetime", "yellow": "tpep_pickup_datetime"}
DROPOFF = {"green": "lpep_dropoff_datetime", "yellow": "tpep_dropoff_datetime"}
