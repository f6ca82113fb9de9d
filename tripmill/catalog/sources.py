"""Readers. Each query writes a given table in the format at hand and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.prelude import total
from tripmill.catalog.registry import query
from tripmill.functions.exact import exact_sum
from tripmill.operators.aggregates import group_count
from tripmill.operators.joins import lookup_join
from tripmill.session import table_name, workspace
from tripmill.sinks.files import json_fields
from tripmill.sources import adapters, files


def write_csv(df, path, codec="none", partitions=()):
    """CSV with a header and second-resolution timestamps."""
    (df.write.option("header", True).option("timestampFormat", files.TIMESTAMP_FORMAT)
     .option("compression", codec).partitionBy(*partitions).csv(path))
    return path


def csv_of(spark, df, label, **options):
    return write_csv(df, workspace(spark, label), **options)


def months_of(df, pickup):
    """Trips with the month they start in, ready to be written one directory per month."""
    return df.withColumns({"year": F.year(pickup), "month": F.month(pickup)})


def by_month(df):
    """Rows gathered by month, so that a month is one file until it grows too large for one."""
    return df.hint("rebalance", "year", "month")


@query("src_csv_header", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM green")
def src_csv_header(spark, d):
    path = csv_of(spark, adapters.green(spark, d), "csv-header")
    return files.csv_text(spark, path)


def _shuffled(df, *surplus):
    """The columns in reverse order, with others in between."""
    columns = [F.col(c) for c in reversed(df.columns)]
    return df.select(*[F.lit("surplus, quoted").alias(c) for c in surplus], *columns)


@query("src_csv_schema", "SELECT * FROM hvfhv")
def src_csv_schema(spark, d):
    """The file has its columns in another order than the schema, and more of them."""
    path = csv_of(spark, _shuffled(adapters.hvfhv(spark, d), "more"), "csv-schema")
    return files.csv_typed(spark, path, schemas.HVFHV)


@query("src_csv_typed", "SELECT * FROM yellow")
def src_csv_typed(spark, d):
    """Two folders of files whose headers differ in order and in surplus columns."""
    rows, root = adapters.yellow(spark, d), workspace(spark, "csv-typed")
    write_csv(rows.where("PULocationID % 2 = 0"), f"{root}/a")
    write_csv(_shuffled(rows.where("NOT PULocationID % 2 = 0 OR PULocationID IS NULL"), "x", "y"),
              f"{root}/b")
    return files.csv_typed(spark, f"{root}/*/*.csv", schemas.YELLOW)


@query("src_csv_infer", "SELECT * FROM yellow")
def src_csv_infer(spark, d):
    path = csv_of(spark, adapters.yellow(spark, d), "csv-infer")
    return files.csv_inferred(spark, path)


@query("src_csv_gzip_glob", "SELECT * FROM yellow")
def src_csv_gzip_glob(spark, d):
    dated = adapters.yellow(spark, d).withColumn("year", F.year("tpep_pickup_datetime"))
    path = csv_of(spark, dated.hint("rebalance", "year"), "csv-gzip", codec="gzip",
                  partitions=["year"])
    return files.csv_gzip(spark, f"{path}/year=*/*.csv.gz", schemas.YELLOW)


@query("src_csv_external_schema", "SELECT * FROM green")
def src_csv_external_schema(spark, d):
    wider = adapters.green(spark, d).withColumn("surplus", F.lit("ignored"))
    path = csv_of(spark, wider, "csv-external")
    return files.csv_external(spark, path, schemas.GREEN)


@query("src_copy_in_columns", """
SELECT CAST(NULL AS VARCHAR) AS unique_row_id, CAST(NULL AS VARCHAR) AS filename,
  * REPLACE (CAST(VendorID AS VARCHAR) AS VendorID, CAST(RatecodeID AS VARCHAR) AS RatecodeID,
    CAST(PULocationID AS VARCHAR) AS PULocationID, CAST(DOLocationID AS VARCHAR) AS DOLocationID)
FROM yellow""")
def src_copy_in_columns(spark, d):
    path = csv_of(spark, adapters.yellow(spark, d), "csv-copy-in")
    raw = files.csv_external(spark, path, schemas.YELLOW)
    return files.copy_in(raw, schemas.loaded("yellow"), schemas.YELLOW_COLUMNS)


INPUTS = {"green": adapters.green, "yellow": adapters.yellow}


def _month_folders(spark, d, *services):
    """Services as Parquet, one folder per service and month."""
    root = workspace(spark, "months")
    for service in services:
        dated = by_month(months_of(INPUTS[service](spark, d), schemas.PICKUP[service]))
        dated.write.partitionBy("year", "month").parquet(f"{root}/{service}")
    return root


MONTH_FOLDER = "{service}/year={year}/month={month}"


@query("src_month_file", """
SELECT * FROM yellow WHERE date_trunc('month', tpep_pickup_datetime) = DATE '1999-03-01'""")
def src_month_file(spark, d):
    path = files.month_path(_month_folders(spark, d, "yellow"), "yellow", 1999, 3, MONTH_FOLDER)
    return files.parquet(spark, path)


@query("src_parquet", "SELECT count(*) AS n, " + total("l_extendedprice") + " AS amount FROM lineitem")
def src_parquet(spark, d):
    return files.parquet(spark, f"{d}/lineitem.parquet").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("l_extendedprice").alias("amount"))


@query("src_parquet_glob", "SELECT * FROM green")
def src_parquet_glob(spark, d):
    return files.parquet(spark, f"{_month_folders(spark, d, 'green')}/green/*/*")


@query("src_parquet_union_by_name", """
SELECT VendorID, PULocationID, total_amount, ehail_fee, trip_type, lpep_pickup_datetime,
  CAST(NULL AS TIMESTAMP) AS tpep_pickup_datetime FROM green
UNION ALL
SELECT VendorID, PULocationID, total_amount, NULL, NULL, NULL, tpep_pickup_datetime FROM yellow""")
def src_parquet_union_by_name(spark, d):
    root = workspace(spark, "union-by-name")
    adapters.green(spark, d).write.parquet(f"{root}/green")
    adapters.yellow(spark, d).write.parquet(f"{root}/yellow")
    return files.parquet_by_name(spark, [f"{root}/green", f"{root}/yellow"]).select(
        "VendorID", "PULocationID", "total_amount", "ehail_fee", "trip_type",
        "lpep_pickup_datetime", "tpep_pickup_datetime")


@query("src_parquet_columns", """
SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice LIMIT 1000""")
def src_parquet_columns(spark, d):
    names = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return files.parquet_head(spark, f"{d}/lineitem.parquet", names, 1000, names)


_INGESTED = """
SELECT pickup_datetime, dropoff_datetime, CAST(passenger_count AS BIGINT) AS passenger_count,
  trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
  total_amount, CAST(payment_type AS BIGINT) AS payment_type, congestion_surcharge,
  CAST(NULL AS DOUBLE) AS airport_fee, store_and_fwd_flag,
  CAST(RatecodeID AS BIGINT) AS ratecode_id, CAST(PULocationID AS BIGINT) AS pulocation_id,
  CAST(DOLocationID AS BIGINT) AS dolocation_id, service_type AS taxi_type
FROM trips"""


@query("src_parquet_months", _INGESTED)
def src_parquet_months(spark, d):
    root = _month_folders(spark, d, "green", "yellow")
    found = files.ingest_months(spark, root, ["yellow", "green"], "1994-11-15", "2002-01-31",
                                MONTH_FOLDER)
    return found.trips.select(schemas.INGESTED.names)


@query("src_empty_with_schema", _INGESTED)
def src_empty_with_schema(spark, d):
    """An ingest without files has all columns, so other trips can be added to it."""
    nothing = files.ingest_months(spark, workspace(spark, "no-files"), ["yellow"],
                                  "1999-01-01", "1999-12-31").trips
    return nothing.unionByName(adapters.ingested(spark, d))


@query("src_json_infer", """
SELECT CAST(PULocationID AS BIGINT) AS PULocationID, trip_distance, total_amount,
  tpep_pickup_datetime FROM rides""")
def src_json_infer(spark, d):
    path = workspace(spark, "json")
    json_fields(adapters.rides(spark, d), ["PULocationID", "trip_distance", "total_amount",
                                           "tpep_pickup_datetime"], path)
    return files.json_inferred(spark, path)


@query("src_json_nested", "SELECT id, title, brand, price FROM products")
def src_json_nested(spark, d):
    path = workspace(spark, "json-nested")
    documents = adapters.products(spark, d)
    documents.write.json(path)
    return files.json_nested(spark, path, "products", documents.schema)


@query("src_seed", """
SELECT LocationID, Borough, Zone, service_zone, count(*) AS n FROM trips
JOIN zones ON PULocationID = LocationID GROUP BY ALL""")
def src_seed(spark, d):
    path = csv_of(spark, adapters.zones(spark, d), "seed")
    counts = group_count(adapters.trips(spark, d), "PULocationID")
    return lookup_join(counts, files.seed(spark, path, schemas.ZONES),
                       F.col("PULocationID") == F.col("LocationID"), "inner").drop("PULocationID")


@query("src_in_memory", """
SELECT t.payment_type, description, count(*) AS n FROM trips t
JOIN payments p ON t.payment_type = p.payment_type GROUP BY 1, 2""")
def src_in_memory(spark, d):
    counts = group_count(adapters.trips(spark, d), "payment_type")
    return lookup_join(counts, files.payment_descriptions(spark), ["payment_type"], "inner")


@query("src_object_store", """
SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY 1""")
def src_object_store(spark, d):
    uri = d if "://" in d else f"file://{d}"
    return group_count(files.parquet(spark, f"{uri}/lineitem.parquet"), "l_linestatus")


@query("src_table_ref", "SELECT VendorID, lpep_pickup_datetime, total_amount FROM green")
def src_table_ref(spark, d):
    name = table_name("green_tripdata")
    adapters.green(spark, d).createOrReplaceTempView(name)
    return files.model(spark, name).select("VendorID", "lpep_pickup_datetime", "total_amount")
