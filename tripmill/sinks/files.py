"""File writers and options of external sinks."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from tripmill import schemas
from tripmill.session import workspace
from tripmill.sources.files import csv_typed, month_path, path_exists


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replace a Parquet directory. Never pass a frame that reads the same directory."""
    df.write.mode("overwrite").parquet(path)


def new_parquet(df: DataFrame, path: str) -> None:
    """Write a Parquet directory; fails when it exists."""
    df.write.mode("errorifexists").parquet(path)


def in_files(df: DataFrame, n: int) -> DataFrame:
    """Rows spread evenly over ``n`` tasks, and so over ``n`` output files."""
    return df.repartition(n)


def single_file(report: DataFrame, path: str) -> None:
    """Write an aggregated report as one file.

    The rows pass through a shuffle to one writer, so the aggregation before it keeps all its
    tasks; ``coalesce(1)`` would run it in a single task.
    """
    report.repartition(1).write.mode("overwrite").parquet(path)


# Raw directory of one service and month, and how to read year and month from it.
RAW_MONTH = "{service}/{year}/{month:02d}"
RAW_MONTH_PATTERN = r"/(\d{4})/(\d{2})/[^/]*$"


def csv_months_to_parquet(spark: SparkSession, raw_root: str, out_root: str, service: str,
                          months: Sequence[tuple[int, int]], template: str = RAW_MONTH,
                          pattern: str = RAW_MONTH_PATTERN) -> list[str]:
    """Convert month directories of CSV to Parquet partitions, skipping those already there.

    All missing months are converted by one job. Rows are gathered by month, and adaptive
    rebalancing splits a large month over several tasks and files. Returns the converted months.
    """
    todo = {}
    for year, month in months:
        raw = month_path(raw_root, service, year, month, template)
        done = f"{out_root}/service_type={service}/year={year}/month={month}"
        if path_exists(spark, raw) and not path_exists(spark, done):
            todo[f"{year}-{month:02d}"] = raw
    if not todo:
        return []

    def from_path(group: int) -> Column:
        return F.regexp_extract(F.col("_file"), pattern, group).cast("int")

    rows = csv_typed(spark, list(todo.values()), schemas.RAW[service], source_file="_file")
    dated = rows.select("*", F.lit(service).alias("service_type"), from_path(1).alias("year"),
                        from_path(2).alias("month")).drop("_file")
    keys = ["service_type", "year", "month"]
    (dated.hint("rebalance", *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(out_root))
    return list(todo)


def json_fields(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write chosen fields as JSON lines."""
    df.select(*columns).write.mode("overwrite").json(path)


def json_event(columns: Sequence[str]) -> Column:
    """One JSON text per row."""
    return F.to_json(F.struct(*columns))


def events(df: DataFrame) -> DataFrame:
    """Rows encoded as JSON events in a ``value`` column."""
    return df.select(json_event(df.columns).alias("value"))


def publish(df: DataFrame, path: str | None = None,
            kafka: Mapping[str, str] | None = None) -> None:
    """Send rows as JSON events to a topic, or to text files when ``path`` is given."""
    if path:
        events(df).write.mode("append").text(path)
    else:
        events(df).write.format("kafka").options(**kafka).save()


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


COPY_BYTES = 4 << 20


def copy_raw(spark: SparkSession, source: str, target: str) -> int:
    """Land files as they are, byte for byte, in the raw area before they are loaded.

    Returns the number of files. ``land`` also tells what they hold.
    """
    return land(spark, source, target).count()


def land(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy all files of a folder and its subfolders; their manifest: ``file`` (below the folder),
    ``length``, ``sha256`` and whether the file was there already (``kept``).

    Tasks stream files through the file systems that the two addresses name and take the digest on
    the way. A file appears under its name only when it is complete and as long as its source. On
    a second run a file that is there with the same digest is left alone. The manifest is stored
    in the shared folder, so that looking at it does not copy again.
    """
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(source)
    file_system = spark_path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = file_system.makeQualified(spark_path).toString().rstrip("/")
    listed, walk = [], file_system.listFiles(spark_path, True)
    while walk.hasNext():
        name = walk.next().getPath().toString().removeprefix(root).lstrip("/")
        if not any(part[0] in "_." for part in name.split("/")):
            listed.append((name,))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        reading, from_root = arrow_fs.FileSystem.from_uri(_uri(root))
        writing, to_root = arrow_fs.FileSystem.from_uri(_uri(target))
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [_copied(reading, f"{from_root}/{n}", writing, f"{to_root}/{n}", attempt)
                     for n in names]
            yield pa.RecordBatch.from_pydict({
                "file": pa.array(names, pa.string()),
                "length": pa.array([f[0] for f in found], pa.int64()),
                "sha256": pa.array([f[1] for f in found], pa.string()),
                "kept": pa.array([f[2] for f in found], pa.bool_())})

    schema = "file string, length bigint, sha256 string, kept boolean"
    paths = spark.createDataFrame(listed, "file string").repartition(max(1, len(listed)))
    manifest = workspace(spark, "landing-manifest")
    paths.mapInArrow(copy, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def _digest(files: arrow_fs.FileSystem, path: str, out=None) -> tuple[int, str]:
    """Length and digest of a file, which goes to ``out`` as it is read."""
    length, digest = 0, hashlib.sha256()
    with files.open_input_stream(path, compression=None) as stream:
        while chunk := stream.read(COPY_BYTES):
            length += len(chunk)
            digest.update(chunk)
            if out:
                out.write(chunk)
    return length, digest.hexdigest()


def _copied(reading: arrow_fs.FileSystem, source: str, writing: arrow_fs.FileSystem, target: str,
            attempt: int) -> tuple[int, str, bool]:
    info = writing.get_file_info(target)
    if info.type == arrow_fs.FileType.File and info.size == reading.get_file_info(source).size:
        there = _digest(writing, target)
        if there == _digest(reading, source):
            return *there, True
    folder, _, name = target.rpartition("/")
    writing.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}.{attempt}"
    with writing.open_output_stream(draft, compression=None) as out:
        found = _digest(reading, source, out)
    if writing.get_file_info(draft).size != found[0]:
        raise OSError(f"{source} was not copied in full")
    writing.move(draft, target)
    return *found, False


def _uri(path: str) -> str:
    """Address with a scheme; Spark writes local ones with a single slash."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else "file://" + os.path.abspath(path)


def jdbc_writer(df: DataFrame, url: str, table: str, mode: str, user: str, password: str,
                batch_size: int = 100_000, connections: int = 8,
                driver: str = "org.postgresql.Driver") -> DataFrameWriter:
    """Database writer; every row is written once, in batches, over a bounded connection count.

    ``mode`` is ``overwrite`` to replace the table or ``append`` to add to it.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    return df.write.format("jdbc").mode(mode).options(
        **jdbc_options(url, table, user, password, batch_size, connections, driver))


def jdbc_options(url: str, table: str, user: str, password: str, batch_size: int = 100_000,
                 connections: int = 8, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password,
            "driver": driver, "batchsize": str(batch_size), "numPartitions": str(connections)}


def warehouse_options(table: str, temp_bucket: str) -> dict[str, str]:
    return {"table": table, "temporaryGcsBucket": temp_bucket}


def warehouse_writer(df: DataFrame, table: str, temp_bucket: str,
                     fmt: str = "bigquery") -> DataFrameWriter:
    """Writer for a warehouse connector that stages through a bucket."""
    return df.write.format(fmt).mode("overwrite").options(
        **warehouse_options(table, temp_bucket))
