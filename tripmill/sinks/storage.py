"""Files and folders through the file system that their address names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    name, files = _opened(spark, path)
    return files.exists(name)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is absent."""
    name, files = _opened(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(name)) if files.exists(name) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    name, files = _opened(spark, path)
    files.delete(name, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there in full or not at all."""
    draft, files = _opened(spark, f"{path}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    name, _ = _opened(spark, path)
    if not files.rename(draft, name):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    name, files = _opened(spark, path)
    stream = files.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
