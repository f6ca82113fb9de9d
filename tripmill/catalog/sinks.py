"""Writers. Each query writes a given table to a fresh place and returns what is stored there."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.aggregates import MONTHLY_SQL
from tripmill.catalog.registry import query
from tripmill.catalog.sources import by_month, csv_of, months_of, write_csv
from tripmill.functions.temporal import month_list
from tripmill.plans import revenue
from tripmill.session import table_name, workspace
from tripmill.sinks import files, tables
from tripmill.sources import adapters
from tripmill.sources.files import csv_text, parquet
from tripmill.operators.filters import date_range

_RECENT = """
SELECT trip_id, VendorID, PULocationID, DOLocationID, pickup_datetime, dropoff_datetime,
  fare_amount, tip_amount, total_amount, pickup_date FROM recent_trips"""


@query("snk_parquet_overwrite", "SELECT * FROM yellow")
def snk_parquet_overwrite(spark, d):
    path = workspace(spark, "overwrite")
    files.overwrite_parquet(adapters.green(spark, d), path)
    files.overwrite_parquet(adapters.yellow(spark, d), path)
    return parquet(spark, path)


@query("snk_parquet_new", "SELECT * FROM green")
def snk_parquet_new(spark, d):
    path = workspace(spark, "new")
    files.new_parquet(adapters.green(spark, d), path)
    return parquet(spark, path)


@query("snk_repartition", "SELECT CAST(24 AS BIGINT) AS n_files, count(*) AS n FROM hvfhv")
def snk_repartition(spark, d):
    path = workspace(spark, "repartition")
    files.new_parquet(files.in_files(adapters.hvfhv(spark, d), 24), path)
    return parquet(spark, path).agg(
        F.count_distinct("_metadata.file_path").alias("n_files"),
        F.count(F.lit(1)).alias("n"))


@query("snk_single_file", MONTHLY_SQL)
def snk_single_file(spark, d):
    path = workspace(spark, "single")
    files.single_file(revenue.monthly(adapters.green(spark, d), adapters.yellow(spark, d)), path)
    return parquet(spark, path)


@query("snk_csv_to_parquet_months", """
SELECT *, 'yellow' AS service_type, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM yellow""")
def snk_csv_to_parquet_months(spark, d):
    raw, out = workspace(spark, "raw-months"), workspace(spark, "pq-months")
    dated = by_month(months_of(adapters.yellow(spark, d), "tpep_pickup_datetime"))
    write_csv(dated, f"{raw}/yellow", partitions=["year", "month"])
    layout = {"template": "{service}/year={year}/month={month}",
              "pattern": r"/year=(\d+)/month=(\d+)/"}
    early, everything = month_list("1995-01-01", "1997-12-31"), month_list("1995-01-01", "2002-12-31")
    files.csv_months_to_parquet(spark, raw, out, "yellow", early, **layout)
    files.csv_months_to_parquet(spark, raw, out, "yellow", everything, **layout)
    return parquet(spark, out)


@query("snk_ctas", "SELECT * FROM green")
def snk_ctas(spark, d):
    return tables.create_as(adapters.green(spark, d), table_name("green"),
                            workspace(spark, "ctas"))


@query("snk_partitioned", _RECENT + """
WHERE pickup_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def snk_partitioned(spark, d):
    stored = tables.create_partitioned(
        adapters.recent_trips(spark, d).drop("pickup_date"), table_name("by_day"),
        workspace(spark, "by-day"), "pickup_datetime")
    return date_range(stored, "pickup_datetime", "2024-01-10", "2024-01-20", "pickup_date")


@query("snk_partitioned_clustered", """
SELECT pickup_date, VendorID, count(*) AS trips FROM recent_trips GROUP BY 1, 2""")
def snk_partitioned_clustered(spark, d):
    stored = tables.create_ranged(
        adapters.recent_trips(spark, d).drop("pickup_date"), table_name("by_day_vendor"),
        workspace(spark, "by-day-vendor"), "pickup_datetime", "VendorID")
    return stored.groupBy("pickup_date", "VendorID").agg(F.count(F.lit(1)).alias("trips"))


@query("snk_create_if_absent", """
SELECT 'x' AS unique_row_id, 'f' AS filename, * REPLACE (CAST(VendorID AS VARCHAR) AS VendorID,
  CAST(RatecodeID AS VARCHAR) AS RatecodeID, CAST(PULocationID AS VARCHAR) AS PULocationID,
  CAST(DOLocationID AS VARCHAR) AS DOLocationID) FROM yellow""")
def snk_create_if_absent(spark, d):
    name, path = table_name("yellow"), workspace(spark, "create")
    for _ in range(2):
        tables.create_if_absent(spark, name, schemas.loaded("yellow"), path)
    rows = adapters.yellow(spark, d).withColumns(
        {"unique_row_id": F.lit("x"), "filename": F.lit("f"),
         **{c: F.col(c).cast("string") for c in ("VendorID", "RatecodeID", "PULocationID",
                                                 "DOLocationID")}})
    tables.append_rows(rows, name)
    return spark.table(name)


@query("snk_truncate_load", "SELECT * FROM green")
def snk_truncate_load(spark, d):
    name = table_name("staging")
    tables.create_if_absent(spark, name, schemas.GREEN, workspace(spark, "truncate"))
    for _ in range(2):
        tables.truncate_load(adapters.green(spark, d), name)
    return spark.table(name)


@query("snk_jdbc_replace_append", """
SELECT * FROM yellow UNION ALL SELECT * FROM yellow""")
def snk_jdbc_replace_append(spark, d):
    """Replace, then append, on a table sink; the database writer takes the same two modes."""
    name, rows = table_name("yellow_taxi"), adapters.yellow(spark, d)
    tables.create_as(rows, name, workspace(spark, "replace-append"))
    tables.append_rows(rows, name)
    return spark.table(name)


@query("snk_schema_ddl", "SELECT * FROM hvfhv")
def snk_schema_ddl(spark, d):
    """Empty table made from a frame's schema, its DDL used to read CSV that then fills it."""
    rows = adapters.hvfhv(spark, d)
    name = table_name("hvfhv")
    tables.create_empty_like(rows, name, workspace(spark, "ddl"))
    path = csv_of(spark, rows, "ddl-csv")
    typed = (spark.read.option("header", True)
             .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
             .schema(tables.schema_ddl(rows)).csv(path))
    tables.append_rows(typed, name)
    return spark.table(name)


@query("snk_json", "SELECT coalesce(brand, 'N/A') AS brand, price FROM products")
def snk_json(spark, d):
    from tripmill.operators.projections import keep_or_default
    path = workspace(spark, "products")
    items = adapters.products(spark, d).select(F.explode("products").alias("p")).select("p.*")
    files.json_fields(keep_or_default(items, ["brand", "price"]), ["brand", "price"], path)
    return spark.read.schema("brand string, price double").json(path)


@query("snk_events_json", "SELECT * FROM rides")
def snk_events_json(spark, d):
    path = workspace(spark, "events")
    files.publish(adapters.rides(spark, d), path)
    return spark.read.schema(schemas.RIDE).json(path)


@query("snk_warehouse_connector", MONTHLY_SQL)
def snk_warehouse_connector(spark, d):
    """The connector is a format name, a table and options; Parquet stands in for it here."""
    path = workspace(spark, "warehouse")
    report = revenue.monthly(adapters.green(spark, d), adapters.yellow(spark, d))
    files.warehouse_writer(report, "reports.monthly", "temp-bucket", "parquet").save(path)
    return parquet(spark, path)


@query("snk_upload_stage", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM green")
def snk_upload_stage(spark, d):
    landed = csv_of(spark, adapters.green(spark, d), "landed")
    raw = workspace(spark, "raw")
    files.copy_raw(spark, landed, raw)
    return csv_text(spark, raw)


@query("snk_temp_view", "SELECT service_type, count(*) AS n FROM trips GROUP BY 1")
def snk_temp_view(spark, d):
    name = table_name("trips_data")
    adapters.trips(spark, d).createOrReplaceTempView(name)
    return spark.sql(f"SELECT service_type, count(1) AS n FROM {name} GROUP BY service_type")
