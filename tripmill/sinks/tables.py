"""Catalog tables: layout, creation and the materialisation strategies applied to them.

Only Parquet is assumed, so there is no multi-writer transaction: one job writes a table at a
time. Changes of partitioned tables go through ``commits``: the result is evaluated and written once
into fresh folders, and a manifest makes the switch to them safe against a lost driver at any step.
Unpartitioned tables are written to a fresh version beside the former one and pointed at it.

A merge first stores its source in the shared folder and works on that copy alone, so rows cannot
differ between the steps; the copy is deleted when the merge ends. Which partitions it touches comes
from their values; those that end up without rows are dropped with their files. A null partition
value is a value like any other. Partition values are held on the driver, as the catalog itself
does; rows never are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripmill.operators import merge
from tripmill.operators.dedupe import keep_first
from tripmill.operators.filters import half_open, later_than
from tripmill.operators.keyfilter import likely
from tripmill.operators.skew import filter_join
from tripmill.session import workspace
from tripmill.sinks import commits, storage
from tripmill.sinks.commits import directories, location


def create_as(df: DataFrame, table: str, path: str) -> DataFrame:
    """Table from a query, replacing an earlier one."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def create_partitioned(df: DataFrame, table: str, path: str, ts: str,
                       date_col: str = "pickup_date") -> DataFrame:
    """Table partitioned by the date of a timestamp.

    Rebalancing gathers a date into few files and splits a hot date over several tasks.
    """
    dated = df.withColumn(date_col, F.to_date(ts))
    (dated.hint("rebalance", date_col).write.mode("overwrite").option("path", path)
     .partitionBy(date_col).saveAsTable(table))
    return df.sparkSession.table(table)


def create_clustered(df: DataFrame, table: str, path: str, ts: str, cluster: str,
                     buckets: int, date_col: str = "pickup_date") -> DataFrame:
    """Table partitioned by date and hashed and sorted by ``cluster`` within each date.

    An equality filter on ``cluster`` opens the files of one bucket. Rows are gathered by date
    and cluster key, so a bucket of a date is few files; a hot pair is split over several tasks.
    """
    dated = df.withColumn(date_col, F.to_date(ts))
    (dated.hint("rebalance", date_col, cluster).write.mode("overwrite").option("path", path)
     .partitionBy(date_col).bucketBy(buckets, cluster).sortBy(cluster).saveAsTable(table))
    return df.sparkSession.table(table)


def create_ranged(df: DataFrame, table: str, path: str, ts: str, cluster: str,
                  date_col: str = "pickup_date", page_rows: int = 2_000) -> DataFrame:
    """Table partitioned by date, its rows in ranges of ``cluster`` within each date.

    Ranges come from Spark's sample of (date, ``cluster``), so the input is evaluated twice. Files
    are sorted and keep bounds for every ``page_rows`` rows: a filter on ``cluster``, by equality or
    by range, skips the files, row groups and pages that cannot match. The number of the input
    partition and a hash of the row part the rows of a hot pair, copies of one row too. Nulls come
    first.
    """
    dated = df.withColumn(date_col, F.to_date(ts))
    hashed = [f.name for f in dated.schema.fields if not _holds_map(f.dataType)]
    keys = [F.col(date_col), F.col(cluster)]
    placed = dated.withColumns({"_part": F.spark_partition_id(), "_salt": F.xxhash64(*hashed)})
    (placed.repartitionByRange(*keys, "_part", "_salt").sortWithinPartitions(*keys)
     .drop("_part", "_salt").write.mode("overwrite").option("path", path)
     .option("parquet.page.row.count.limit", str(page_rows))
     .partitionBy(date_col).saveAsTable(table))
    return df.sparkSession.table(table)


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType, path: str,
                     partition: Sequence[T.StructField] = ()) -> None:
    """Empty table with column comments, unless it exists."""
    def column(field: T.StructField) -> str:
        comment = field.metadata.get("comment", "").replace("'", "\\'")
        return f"`{field.name}` {field.dataType.simpleString()} COMMENT '{comment}'"
    columns = ", ".join(column(f) for f in [*schema.fields, *partition])
    layout = f"PARTITIONED BY ({', '.join(f.name for f in partition)})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} "
              f"LOCATION '{path}'")


def schema_ddl(df: DataFrame) -> str:
    return df.schema.toDDL()


def create_empty_like(df: DataFrame, table: str, path: str) -> None:
    """Empty table with the columns of a frame."""
    df.limit(0).write.mode("overwrite").option("path", path).saveAsTable(table)


def truncate_load(df: DataFrame, table: str) -> None:
    """Replace all rows of a table that exists, in its own column order."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def append_rows(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def swap(df: DataFrame, table: str) -> None:
    """Replace an unpartitioned table, also by rows read from it.

    Rows go to a new version beside the table's present directory and the table is then pointed
    there, so a reader sees either the old or the new rows. Only the version before is kept, for
    readers that have already begun.
    """
    spark = df.sparkSession
    stem, number = _version(location(spark, table))
    df.write.mode("errorifexists").parquet(_versioned(stem, number + 1))
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_versioned(stem, number + 1)}'")
    spark.catalog.refreshTable(table)
    if number:
        storage.delete(spark, _versioned(stem, number - 1))


def _version(path: str) -> tuple[str, int]:
    found = re.fullmatch(r"(.*)-version-(\d+)", path.rstrip("/"))
    return (found[1], int(found[2])) if found else (path.rstrip("/"), 0)


def _versioned(stem: str, number: int) -> str:
    return f"{stem}-version-{number}" if number else stem


def overwrite_partitions(df: DataFrame, table: str, partition: str) -> None:
    """Replace the partitions that occur in ``df``; others stay. ``df`` may read the table."""
    commits.commit(df, table, partition)


def in_partitions(df: DataFrame, partition: str, wanted: DataFrame) -> DataFrame:
    """Rows in the partitions that occur in ``wanted``, the null one included.

    The values become a literal filter, which prunes directories while planning.
    """
    return _of_values(df, partition, _values(wanted, partition))


def _values(df: DataFrame, partition: str) -> list[Any]:
    return [r[0] for r in df.select(partition).distinct().collect()]


def _of_values(df: DataFrame, partition: str, values: Sequence[Any]) -> DataFrame:
    listed = [v for v in values if v is not None]
    wanted = F.col(partition).isin(listed)
    return df.where(wanted | F.col(partition).isNull() if len(listed) < len(values) else wanted)


@contextmanager
def stored(source: DataFrame, label: str, reader: SparkSession | None = None
           ) -> Iterator[DataFrame]:
    """The rows, computed once and kept in the shared folder until the block ends."""
    spark = source.sparkSession
    path = workspace(spark, label)
    try:
        source.write.parquet(path)
        yield (reader or spark).read.schema(source.schema).parquet(path)
    finally:
        storage.delete(spark, path)


def insert_new(source: DataFrame, table: str, keys: Sequence[str], dedupe_source: bool = False,
               order: Sequence[str | Column] = ()) -> None:
    """Insert-only merge: rows with unknown keys are appended, nothing is rewritten.

    The target's keys are tested against a filter of the source's keys while they are scanned; only
    those that may match are shuffled, and a join confirms them.
    """
    target = source.sparkSession.table(table)
    with stored(source, "insert-source") as rows:
        known = likely(target.select(*keys), rows, keys)
        append_rows(merge.new_rows(known, rows, keys, dedupe_source, order), table)


def upsert(source: DataFrame, table: str, keys: Sequence[str], partition: str,
           order: Sequence[str | Column] = (), key_fixes_partition: bool = False,
           is_stored: bool = False, settings: Mapping[str, str] | None = None) -> None:
    """Merge into a partitioned table by key, rewriting only partitions that change.

    A matched row may sit in another partition than its replacement. Those partitions are found
    by a scan of key and partition columns alone, which ``key_fixes_partition`` skips when equal
    keys always have the same partition value. A source that ``is_stored`` is not stored again;
    ``settings`` become table properties together with the rows.
    """
    rows = keep_first(source, keys, order) if order else source
    with nullcontext(rows) if is_stored else stored(rows, "merge-source") as rows:
        _merge(rows, table, keys, partition, key_fixes_partition, merge.upsert, settings)


def delete_insert(source: DataFrame, table: str, keys: Sequence[str], partition: str,
                  key_fixes_partition: bool = False) -> None:
    """Delete matching keys and insert every source row, partition by partition."""
    with stored(source, "merge-source") as rows:
        _merge(rows, table, keys, partition, key_fixes_partition, merge.delete_insert)


def _merge(source: DataFrame, table: str, keys: Sequence[str], partition: str,
           key_fixes_partition: bool, strategy: Callable[..., DataFrame],
           settings: Mapping[str, str] | None = None) -> None:
    commits.recover(source.sparkSession, table)
    target = source.sparkSession.table(table)
    changed = _values(source, partition)
    if not key_fixes_partition:
        matched = filter_join(target.select(*{*keys, partition}), source, keys, "left_semi")
        changed = list({*changed, *_values(matched, partition)})
    touched = _of_values(target, partition, changed)
    commits.commit(strategy(touched, source, keys), table, partition,
                   _texts(target, partition, changed), settings)


def _texts(df: DataFrame, partition: str, values: Sequence[Any]) -> list[str | None]:
    """Partition values as the catalog writes them."""
    spark = df.sparkSession
    kind = T.StructType([T.StructField("v", df.schema[partition].dataType)])
    rows = spark.createDataFrame([(v,) for v in values], kind)
    return [r[0] for r in rows.select(F.col("v").cast("string")).collect()]


def replace_interval(source: DataFrame, table: str, ts: str, start: str, end: str,
                     partition: str) -> None:
    """Replace the rows with ``start <= ts < end`` of a table partitioned by the date of ``ts``.

    Only the dates of the interval are read and written.
    """
    spark = source.sparkSession
    commits.recover(spark, table)
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    inside = F.col(partition).between(F.to_date(first), F.to_date(last))
    present = [(v,) for v in directories(spark, table) if v is not None]
    dates = spark.createDataFrame(present, "v string").withColumn(partition, F.to_date("v"))
    touched = spark.table(table).where(inside)
    # The interval bounds the rows read and the source is read once: nothing needs to be stored.
    result = merge.replace_interval(touched, source, ts, start, end, partition)
    commits.commit(result, table, partition, [r["v"] for r in dates.where(inside).collect()])


def incremental(source: DataFrame, table: str, ts: str, keys: Sequence[str], partition: str,
                order: Sequence[str | Column] = (), lookback: timedelta | None = None,
                key_fixes_partition: bool = False) -> None:
    """First run loads everything, later runs upsert the rows newer than the table's newest."""
    spark = source.sparkSession
    target = spark.table(table)
    if target.isEmpty():
        rows = keep_first(source, keys, order) if order else source
        overwrite_partitions(rows, table, partition)
        return
    newest = newest_in(spark, table, ts, partition)
    newer = source if newest is None else later_than(source, ts, newest, lookback, partition)
    upsert(newer.where(F.col(ts).isNotNull()), table, keys, partition, order, key_fixes_partition)


def add_columns(source: DataFrame, table: str) -> None:
    """Add columns of the source the table lacks; rows already stored are null there."""
    spark = source.sparkSession
    known = set(spark.table(table).columns)
    missing = [f for f in source.schema.fields if f.name not in known]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def newest_in(spark: SparkSession, table: str, ts: str, partition: str) -> Any:
    """Largest ``ts`` of a table partitioned by the date of ``ts``; reads its newest partition.

    The next older one is read only where the newest has no such value.
    """
    target = spark.table(table)
    kind = target.schema[partition].dataType
    for name in sorted((v for v in directories(spark, table) if v is not None), reverse=True):
        rows = target.where(F.col(partition) == F.lit(name).cast(kind))
        newest = rows.agg(F.max(ts)).first()[0]
        if newest is not None:
            return newest
    return None
