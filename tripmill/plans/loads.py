"""Staged load of one file into the trip table of its service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmill import schemas
from tripmill.functions.keys import trip_key_7
from tripmill.operators import merge
from tripmill.sinks import tables
from tripmill.sources.files import copy_in, csv_external

DATE = T.StructField("pickup_date", T.DateType(), True, {"comment": "date of the pickup"})


def stage(raw: DataFrame, service: str, filename: str) -> DataFrame:
    """Raw rows in the loaded schema, with row id and file name set on every row."""
    schema = schemas.loaded(service)
    staged = copy_in(raw, schema, schemas.RAW[service].names)
    return staged.withColumns({
        "unique_row_id": trip_key_7(schemas.PICKUP[service], schemas.DROPOFF[service]),
        "filename": F.lit(filename)})


def create_tables(spark: SparkSession, table: str, staging_table: str, service: str,
                  path: str, staging_path: str) -> None:
    """Trip table partitioned by pickup date and its staging table, unless they exist."""
    schema = schemas.loaded(service)
    tables.create_if_absent(spark, table, schema, path, [DATE])
    tables.create_if_absent(spark, staging_table, T.StructType([*schema.fields, DATE]),
                            staging_path)


def load_file(spark: SparkSession, path: str, table: str, staging_table: str, service: str,
              filename: str, dedupe_source: bool = False) -> None:
    """Replace the staging table by one CSV file, then insert the rows the table lacks.

    Text is parsed and hashed once, into the staging table. The trip table is searched only in
    the pickup dates of the file: the row id contains the pickup instant, so equal ids have
    equal dates.
    """
    raw = csv_external(spark, path, schemas.RAW[service])
    staged = stage(raw, service, filename)
    tables.truncate_load(
        staged.withColumn(DATE.name, F.to_date(schemas.PICKUP[service])), staging_table)
    merge_staged(spark, table, staging_table, dedupe_source)


def merge_staged(spark: SparkSession, table: str, staging_table: str,
                 dedupe_source: bool = False) -> None:
    """Insert the staged rows whose id the trip table does not have."""
    staged = spark.table(staging_table)
    known = tables.in_partitions(spark.table(table), DATE.name, staged)
    rows = merge.new_rows(known, staged, ["unique_row_id"], dedupe_source)
    tables.append_rows(rows.hint("rebalance", DATE.name), table)
