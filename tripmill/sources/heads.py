"""First lines and footers of many files, read in tasks.

The driver lists paths, as it must to plan a scan, and then learns one row for each distinct head.
Tasks open files through the file systems that pyarrow knows (local, HDFS, S3, GCS) and read a head
only. Files of other systems or compressions go through Spark's own readers instead.
"""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

FILES_A_TASK = 64
COMPRESSED = (".deflate", ".snappy", ".zst", ".lz4", ".bz2", ".gz")
KNOWN_COMPRESSED = (".bz2", ".gz")
MOST_OF_A_LINE = 1 << 24


def _paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    return rows.repartition(max(1, -(-len(paths) // FILES_A_TASK)))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark would read it by."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(name).toString()


def opened(path: str) -> tuple[arrow_fs.FileSystem, str] | None:
    """File system and name of a path; None for a system that pyarrow does not know."""
    try:
        return arrow_fs.FileSystem.from_uri(quote(path, safe=":/@"))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return None


def _first_line(path: str) -> tuple[bool, str | None]:
    """Whether the file could be opened here, and its first line, None if it has no byte."""
    found = opened(path)
    if found is None or path.endswith(COMPRESSED) and not path.endswith(KNOWN_COMPRESSED):
        return False, None
    files, name = found
    with files.open_input_stream(name, compression="detect") as stream:
        line = b""
        while b"\n" not in line and b"\r" not in line and len(line) < MOST_OF_A_LINE:
            more = stream.read(1 << 14)
            if not more:
                break
            line += more
    return True, line.decode("utf-8", "replace").splitlines()[0] if line.strip(b"\r\n") else \
        "" if line else None


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The distinct first lines of text files, each with its files; empty files are left out.

    Paths are as Spark's readers take them, without escapes.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            seen = [_first_line(p) for p in names]
            yield pa.RecordBatch.from_pydict({
                "path": pa.array(names, pa.string()), "known": pa.array([k for k, _ in seen]),
                "line": pa.array([x for _, x in seen], pa.string())})

    if not paths:
        return {}
    found = _paths(spark, paths).mapInArrow(read, "path string, known boolean, line string")
    groups = found.groupBy("known", "line").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    lines: dict[str, list[str]] = {}
    for row in groups.collect():
        if row["known"]:
            if row["line"] is not None:
                lines[row["line"]] = row["paths"]
        else:
            for line, of in _by_spark(spark, row["paths"]).items():
                lines.setdefault(line, []).extend(of)
    return lines


def _by_spark(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The same through Spark's text reader, which reads whole files but only keeps one line."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    rows = spark.read.text(list(paths)).select(
        path.alias("path"), "value",
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
    firsts = rows.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return {r["line"]: r["paths"] for r in firsts.groupBy("line").agg(
        F.collect_list("path").alias("paths")).collect()}


def header_names(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.removeprefix("﻿")]), ()))


def _footer(path: str) -> tuple[str, str | None, int | None]:
    """``missing``, ``unreadable``, ``unknown`` or ``read``; digest of the schema; rows.

    Only what the file itself is to blame for counts as unreadable; a lost connection raises, so
    that Spark tries again and fails in the end.
    """
    found = opened(path)
    if found is None:
        return "unknown", None, None
    files, name = found
    info = files.get_file_info(name)
    if info.type == arrow_fs.FileType.NotFound:
        return "missing", None, None
    names = [name]
    if info.type == arrow_fs.FileType.Directory:
        inside = files.get_file_info(arrow_fs.FileSelector(name, recursive=True))
        names = sorted(f.path for f in inside if f.type == arrow_fs.FileType.File
                       and not f.base_name.startswith(("_", ".")))
    if not names:
        return "unreadable", None, None
    schemas, rows = [], 0
    for each in names:
        with files.open_input_file(each) as file:
            try:
                footer = pq.ParquetFile(file).metadata
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
                return "unreadable", None, None
        rows += footer.num_rows
        schemas.append(f"{footer.schema}{(footer.metadata or {}).get(b'org.apache.spark.sql.parquet.row.metadata')}")
    # A reader takes the schema of a folder from one of its files.
    text = schemas[0].partition("\n")[2]  # the first line is an address in memory
    return "read", hashlib.sha256(text.encode()).hexdigest(), rows


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path``, ``state``, ``schema`` (a digest) and ``rows`` of Parquet files or folders.

    Paths have a scheme (``qualified``) and no escapes.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            seen = [_footer(p) for p in names]
            yield pa.RecordBatch.from_pydict({
                "path": pa.array(names, pa.string()),
                "state": pa.array([s for s, _, _ in seen], pa.string()),
                "schema": pa.array([d for _, d, _ in seen], pa.string()),
                "rows": pa.array([n for _, _, n in seen], pa.int64())})
    return _paths(spark, paths).mapInArrow(
        read, "path string, state string, schema string, rows bigint")
