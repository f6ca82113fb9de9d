"""Batch readers: CSV, Parquet, JSON, months of files, lookups and bucket settings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripmill import schemas
from tripmill.functions.temporal import month_list
from tripmill.sources import heads

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def csv_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header row, every column text. No pass over the data is made."""
    return spark.read.option("header", True).csv(path)


def csv_inferred(spark: SparkSession, path: str | Sequence[str],
                 sampling: float = 1.0) -> DataFrame:
    """CSV with types found by one extra pass over ``sampling`` of the rows."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling).csv(path))


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names of the header lines, each with the files that begin with it.

    Tasks read the first line of every file, compressed or not, and nothing else.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    listed = [unquote(f) for f in spark.read.text(path).inputFiles()]
    for line, files in heads.first_lines(spark, listed).items():
        found.setdefault(heads.header_names(line), []).extend(files)
    return found


def csv_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
              timestamp_format: str = TIMESTAMP_FORMAT, unparsed: str | None = None,
              source_file: str | None = None) -> DataFrame:
    """CSV matched to a declared schema by the names in each file's header.

    Files may have their columns in different orders: there is one scan for each distinct header.
    Columns a file lacks are null, surplus ones are not read. Values that do not parse become null;
    ``unparsed`` names a column that lists the columns in which that happened, ``source_file`` one
    with the path of the row's file.
    """
    def typed(field: T.StructField, names: tuple[str, ...]) -> tuple[Column, Column]:
        at = next((i for i, n in enumerate(names) if n.lower() == field.name.lower()), None)
        if at is None:
            return F.lit(None).cast(field.dataType).alias(field.name), F.lit(None).cast("string")
        text = F.col(f"_{at}")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.try_to_timestamp(text, F.lit(timestamp_format)).cast(field.dataType)
        else:
            value = text.try_cast(field.dataType)
        failed = F.when(text.isNotNull() & value.isNull(), F.lit(field.name))
        return value.alias(field.name), failed

    result = empty(spark, T.StructType(
        [*schema.fields, *([T.StructField(unparsed, T.ArrayType(T.StringType()))]
                           if unparsed else []),
         *([T.StructField(source_file, T.StringType())] if source_file else [])]))
    for names, paths in csv_headers(spark, path).items():
        text = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
        rows = (spark.read.option("header", True).option("mode", "PERMISSIVE").schema(text)
                .csv(paths))
        columns = [typed(f, names) for f in schema.fields]
        values = [c for c, _ in columns]
        if unparsed:
            values.append(F.array_compact(F.array(*[f for _, f in columns])).alias(unparsed))
        if source_file:
            values.append(F.col("_metadata.file_path").alias(source_file))
        result = result.unionByName(rows.select(*values))
    return result


def csv_external(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType) -> DataFrame:
    """CSV read by position: the header is skipped and surplus trailing columns are ignored."""
    return (spark.read.option("header", True).option("enforceSchema", True)
            .option("timestampFormat", TIMESTAMP_FORMAT).schema(schema).csv(path))


def csv_gzip(spark: SparkSession, glob: str, schema: T.StructType | None = None) -> DataFrame:
    """Gzip CSV files matched by a wildcard.

    A gzip file is one task, however large. The result is rebalanced so that later stages are
    not stuck with one task per file; sizes are evened out at run time.
    """
    raw = csv_typed(spark, glob, schema) if schema else csv_text(spark, glob)
    return raw.hint("rebalance")


def copy_in(source: DataFrame, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """Source columns placed into a wider table; columns not named are null."""
    named = set(columns)
    return source.select(*[
        (F.col(f.name) if f.name in named else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet directory, file or wildcard."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def parquet_by_name(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files whose columns differ, matched by name; absent columns are null."""
    reader = spark.read.option("mergeSchema", True)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def parquet_head(spark: SparkSession, path: str, columns: Sequence[str], n: int,
                 order: Sequence[str]) -> DataFrame:
    """First ``n`` rows of a few columns. Only those columns are read; top-n needs no full sort."""
    return spark.read.parquet(path).select(*columns).orderBy(*order).limit(n)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or wildcard matches anything on its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop_path)
    return found is not None and len(found) > 0


# Fixed value: name of the published file of one service and month.
MONTH_FILE = "{service}_tripdata_{year}-{month:02d}.parquet"


def month_path(root: str, service: str, year: int, month: int,
               template: str = MONTH_FILE) -> str:
    """Path of one month's file."""
    return f"{root}/{template.format(service=service, year=year, month=month)}"


@dataclass(frozen=True)
class Ingest:
    """Trips of several months, the files that were not there or could not be read, and the rows
    that the footers of the others promise."""

    trips: DataFrame
    skipped: list[str]
    rows: int


def ingest_months(spark: SparkSession, root: str, services: Iterable[str],
                  first: str | date, last: str | date, template: str = MONTH_FILE) -> Ingest:
    """Trips of all services and months in a closed range, in the ingestion schema.

    Published months differ in column types and in the case of names, so files are grouped by the
    schema in their footer: one job reads all footers, and there is one scan for each distinct
    schema, cast to the ingestion schema. A file that is missing or that is no Parquet is reported,
    not an error; a store that does not answer is an error. With no file at all the result is empty
    but has the full schema.
    """
    result, skipped, rows = empty(spark, schemas.INGESTED), [], 0
    home = heads.qualified(spark, root)
    paths = {month_path(home, service, y, m, template): service
             for service in services for y, m in month_list(first, last)}
    alike: dict[tuple[str, str], list[str]] = {}
    for path, state, schema, n in sorted(map(tuple, heads.footers(spark, list(paths)).collect())):
        if state == "unknown":  # a store that only Spark reads
            found = footer_schema(spark, path) if path_exists(spark, path) else None
            state, schema = ("read", found.json()) if found else ("missing", None)
        if state == "read":
            alike.setdefault((paths[path], schema), []).append(path)
            rows += n or 0
        else:
            skipped.append(path)
    for (service, _), files in alike.items():
        found = spark.read.schema(spark.read.parquet(files[0]).schema).parquet(*files)
        result = result.unionByName(
            _as_ingested(found).withColumn("taxi_type", F.lit(service)),
            allowMissingColumns=True)
    order = list(paths)
    named = [root + p.removeprefix(home) for p in sorted(skipped, key=order.index)]
    return Ingest(result, named, rows)


def footer_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a Parquet file or folder; None if it cannot be read."""
    try:
        return spark.read.parquet(path).schema
    except (PySparkException, Py4JJavaError):
        return None


def _as_ingested(frame: DataFrame) -> DataFrame:
    """Columns by their ingestion names and types, whatever their case."""
    known = {f.name.lower(): f for f in schemas.INGESTED.fields}
    names = {k.lower(): v for k, v in schemas.INGESTED_NAMES.items()}
    columns = []
    for c in frame.columns:
        name = names.get(c.lower(), c)
        field = known.get(name.lower())
        columns.append(F.col(f"`{c}`").try_cast(field.dataType).alias(field.name) if field
                       else F.col(f"`{c}`").alias(name.lower()))
    return frame.select(*columns)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def json_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON with types found by one extra pass."""
    return spark.read.option("multiLine", multi_line).json(path)


def json_nested(spark: SparkSession, path: str, array: str = "products",
                schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Documents holding an array of objects, one row per object."""
    reader = spark.read.option("multiLine", multi_line)
    documents = (reader.schema(schema) if schema else reader).json(path)
    return documents.select(F.explode(array).alias("item")).select("item.*")


def seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small lookup kept as CSV. A malformed row fails the load."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(schema).csv(path))


def lookup(spark: SparkSession, labels: Mapping[int, str], schema: T.StructType) -> DataFrame:
    """Literal code-to-label rows as a table."""
    rows = ", ".join(f"({int(k)}, :label{i})" for i, k in enumerate(labels))
    args = {f"label{i}": v for i, v in enumerate(labels.values())}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(schema.names)})", args)


def payment_descriptions(spark: SparkSession) -> DataFrame:
    return lookup(spark, schemas.PAYMENT_DESCRIPTIONS, schemas.PAYMENT_LOOKUP)


def payment_names(spark: SparkSession) -> DataFrame:
    return lookup(spark, schemas.PAYMENT_TYPE_NAMES, schemas.PAYMENT_NAMES)


def bucket_conf(keyfile: str, connector_jar: str | None = None) -> dict[str, str]:
    """Session settings for reading ``gs://`` paths with a service-account key file."""
    conf = {
        "spark.hadoop.google.cloud.auth.service.account.enable": "true",
        "spark.hadoop.google.cloud.auth.service.account.json.keyfile": keyfile,
        "spark.hadoop.fs.gs.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem",
        "spark.hadoop.fs.AbstractFileSystem.gs.impl":
            "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFS",
        "spark.hadoop.fs.gs.auth.service.account.enable": "true",
        "spark.hadoop.fs.gs.auth.service.account.json.keyfile": keyfile,
    }
    if connector_jar:
        conf["spark.jars"] = connector_jar
    return conf


def model(spark: SparkSession, name: str) -> DataFrame:
    """Another model or declared source, by its catalog name."""
    return spark.table(name)
