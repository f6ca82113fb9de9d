"""Commits of whole partitions that survive a lost driver at any moment.

The new content is computed and written once, into fresh partition folders beside the table; the
present files stay as they are. A manifest then names, for each partition, its former and its new
folder. From the moment the manifest is there the commit counts: the catalog is pointed to the new
folders, emptied partitions are dropped, table properties are set, former folders are deleted, and
at last the manifest. Each of these steps may be repeated, so ``recover``, which every commit calls
first, replays a manifest that was left and deletes what was written for a commit without one.

A reader sees each partition as it was or as it is now; one that plans while the partitions are
being pointed may see some old and some new ones, and one that has begun to read a former folder
when it is deleted fails. One job writes a table at a time. Partition values are held on the driver,
as the catalog itself does; rows never are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tripmill.session import table_name
from tripmill.sinks import storage

# Fixed value: directory name of the null partition.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"

STATEMENTS_AT_ONCE = 100


def reached(step: str) -> None:
    """Called after each step of a commit; tests stop one here."""


def quoted(text: str) -> str:
    """A text as a literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def location(spark: SparkSession, table: str, partition: str = "") -> str:
    """Directory of a table, or of one partition given as a specification."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    names = [r["col_name"] for r in rows]
    part = "# Detailed Partition Information" if partition else "# Detailed Table Information"
    return rows[names.index("Location", names.index(part))]["data_type"]


def spec(partition: str, value: str | None) -> str:
    return f"PARTITION (`{partition}` = {'null' if value is None else quoted(value)})"


def directories(spark: SparkSession, table: str) -> dict[str | None, str]:
    """Directory name of each partition in the catalog, by the text of its value."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = unquote(row[0].partition("=")[2])
        found[None if value == NULL_DIRECTORY else value] = row[0]
    return found


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _root(spark: SparkSession, table: str) -> str:
    return f"{location(spark, table).rstrip('/')}-commits"


def commit(result: DataFrame, table: str, partition: str, replaced: Iterable[str | None] = (),
           settings: Mapping[str, str] | None = None) -> None:
    """Replace the partitions that get rows of ``result``, and drop those ``replaced`` that get none.

    ``result`` may read the table. ``replaced`` are texts of partition values; ``settings`` become
    table properties together with the rows.
    """
    spark = result.sparkSession
    recover(spark, table)
    root, number = _root(spark, table), uuid.uuid4().hex
    storage.write_text(spark, f"{root}/{number}.open", "")
    reached("opened")
    written = _write(result, table, partition, f"{root}/{number}")
    reached("written")
    present = directories(spark, table)
    entries = []
    for value in {*written, *(set(replaced) & present.keys())}:
        entries.append({
            "value": value,
            "new": f"{root}/{number}/{written[value]}" if value in written else None,
            "old": location(spark, table, spec(partition, value)) if value in present else None})
    manifest = {"partition": partition, "entries": entries, "settings": dict(settings or {})}
    storage.write_text(spark, f"{root}/{number}.json", json.dumps(manifest))
    reached("recorded")
    _finish(spark, table, root, number)


def _write(result: DataFrame, table: str, partition: str, folder: str) -> dict[str | None, str]:
    """Write rows as the table would hold them; directory names of the partitions they fill."""
    spark = result.sparkSession
    shadow = table_name("commit")
    spark.sql(f"CREATE TABLE {shadow} LIKE {table} LOCATION {quoted(folder)}")
    try:
        columns = spark.table(table).columns
        result.select(*columns).hint("rebalance", partition).write.insertInto(shadow)
        found = directories(spark, shadow)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {shadow}")
    storage.delete(spark, f"{folder}/_SUCCESS")
    return found


def _finish(spark: SparkSession, table: str, root: str, number: str) -> None:
    manifest = json.loads(storage.read_text(spark, f"{root}/{number}.json"))
    storage.delete(spark, f"{root}/{number}.open")
    partition, entries = manifest["partition"], manifest["entries"]
    present = directories(spark, table)
    added = [e for e in entries if e["new"] and e["value"] not in present]
    for at in range(0, len(added), STATEMENTS_AT_ONCE):
        listed = " ".join(f"{spec(partition, e['value'])} LOCATION {quoted(e['new'])}"
                          for e in added[at:at + STATEMENTS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")
    reached("added")
    for entry in entries:
        value = entry["value"]
        if value in present and entry["new"]:
            spark.sql(f"ALTER TABLE {table} {spec(partition, value)} "
                      f"SET LOCATION {quoted(entry['new'])}")
        elif value in present:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec(partition, value)}")
        reached("pointed")
    if manifest["settings"]:
        listed = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in manifest["settings"].items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    spark.catalog.refreshTable(table)
    reached("set")
    for entry in entries:
        if entry["old"]:
            storage.delete(spark, entry["old"])
            _delete_if_empty(spark, entry["old"].rpartition("/")[0], root)
    _delete_if_empty(spark, f"{root}/{number}", root)
    reached("cleaned")
    storage.delete(spark, f"{root}/{number}.json")


def _delete_if_empty(spark: SparkSession, folder: str, root: str) -> None:
    """Delete the folder of an earlier commit once none of its partitions is left."""
    inside = folder.rpartition("/")[0].rpartition("/")[2] == root.rpartition("/")[2]
    if inside and not storage.names_in(spark, folder):
        storage.delete(spark, folder)


def recover(spark: SparkSession, table: str) -> None:
    """Finish a commit that was recorded, and undo one that was not."""
    root = _root(spark, table)
    names = storage.names_in(spark, root)
    for name in names:
        number, _, kind = name.partition(".")
        if kind == "json":
            _finish(spark, table, root, number)
        elif kind == "open" and f"{number}.json" not in names:
            storage.delete(spark, f"{root}/{number}")
            storage.delete(spark, f"{root}/{number}.json.draft")
            storage.delete(spark, f"{root}/{name}")
