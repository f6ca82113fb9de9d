from __future__ import annotations

import gzip
import json
import os
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan_of, scans_of
from tripmill import schemas, session
from tripmill.plans import loads
from tripmill.session import table_name
from tripmill.operators import merge
from tripmill.sinks import commits, files as out, tables
from tripmill.sources import adapters, files
from tripmill.operators.filters import date_range, half_open

DAY = datetime(2020, 1, 1)


def names_in(path):
    return [n for n in os.listdir(path) if not n.startswith(("_", "."))]


def dated(spark, *pairs):
    """Rows ``(k, day, v)`` with their date."""
    df = spark.createDataFrame([(k, DAY + timedelta(days=d), v) for k, d, v in pairs],
                               "k int, ts timestamp, v string")
    return df.withColumn("day", F.to_date("ts"))


def stored(spark, tmp_path, df):
    name = table_name("t")
    tables.create_partitioned(df.drop("day"), name, str(tmp_path / name), "ts", "day")
    return name


def keyed(spark, name):
    return sorted((r.k, r.day.day, r.v) for r in spark.table(name).collect())


# Readers --------------------------------------------------------------------------------------

def csv_file(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt") as handle:
            handle.write("\n".join(lines) + "\n")
    else:
        path.write_text("\n".join(lines) + "\n")


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])


def test_gzip_months_with_surplus_and_bad_values(spark, tmp_path, rows):
    csv_file(tmp_path / "t_2019-01.csv.gz", "a,b,more", "1,1.5,x", "2,oops,y")
    csv_file(tmp_path / "t_2019-02.csv.gz", "a,b,more", "3,2.5,z")
    csv_file(tmp_path / "t_2020-01.csv.gz", "a,b,more", "4,0.5,z")
    got = files.csv_gzip(spark, str(tmp_path / "t_2019-*.csv.gz"), SCHEMA)
    assert rows(got) == [(1, 1.5), (2, None), (3, 2.5)]
    text = files.csv_gzip(spark, str(tmp_path / "t_2020-*.csv.gz"))
    assert rows(text) == [("4", "0.5", "z")]


def test_csv_forms(spark, tmp_path, rows):
    csv_file(tmp_path / "x.csv", "a,b,surplus", "1,1.5,x", ",,")
    path = str(tmp_path / "x.csv")
    assert files.csv_text(spark, path).dtypes == [("a", "string"), ("b", "string"),
                                                  ("surplus", "string")]
    assert dict(files.csv_inferred(spark, path).dtypes)["b"] == "double"
    assert rows(files.csv_external(spark, path, SCHEMA)) == [(None, None), (1, 1.5)]


def test_copy_in_leaves_other_columns_null(spark, rows):
    source = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, c string")
    wide = T.StructType([*SCHEMA.fields, T.StructField("d", T.StringType())])
    assert rows(files.copy_in(source, wide, ["a", "b"])) == [(1, 2.5, None)]


def test_seed_fails_on_malformed_rows(spark, tmp_path):
    csv_file(tmp_path / "seed.csv", "payment_type,description", "x,Cash")
    with pytest.raises(Exception):
        files.seed(spark, str(tmp_path / "seed.csv"), schemas.PAYMENT_LOOKUP).collect()


def test_ingest_renames_both_services_and_reports_missing_months(spark, tmp_path):
    def month(service, year_month, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(
            str(tmp_path / f"{service}_tripdata_{year_month}.parquet"))
    month("yellow", "2019-01", [(DAY, DAY, 1, 2, 1, 5.0)],
          "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, "
          "DOLocationID int, RatecodeID int, fare_amount double")
    month("yellow", "2019-02", [(DAY, 1.0, 9)],
          "tpep_pickup_datetime timestamp, Airport_fee double, passenger_count bigint")
    month("green", "2019-01", [(DAY, DAY, 3)],
          "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, PULocationID bigint")
    got = files.ingest_months(spark, str(tmp_path), ["yellow", "green"], "2019-01-31",
                              "2019-02-01")
    assert [s.rsplit("/", 1)[1] for s in got.skipped] == ["green_tripdata_2019-02.parquet"]
    assert got.trips.schema.names[:19] == schemas.INGESTED.names
    found = got.trips.orderBy("taxi_type", "passenger_count").collect()
    assert [r.taxi_type for r in found] == ["green", "yellow", "yellow"]
    assert all(r.pickup_datetime == DAY for r in found)
    assert {r.pulocation_id for r in found} == {3, 1, None}
    assert [r.airport_fee for r in found] == [None, None, 1.0]


def test_ingest_of_nothing_has_the_schema(spark, tmp_path):
    got = files.ingest_months(spark, str(tmp_path), ["yellow"], "2019-01-01", "2019-03-31")
    assert got.trips.schema.names == schemas.INGESTED.names and got.trips.count() == 0
    assert len(got.skipped) == 3


def test_nested_products_without_brand(spark, tmp_path):
    (tmp_path / "products.json").write_text(json.dumps(
        {"products": [{"brand": "A", "price": 1.5}, {"price": 2.0}]}, indent=1))
    got = files.json_nested(spark, str(tmp_path / "products.json"), multi_line=True)
    assert {(r.brand, r.price) for r in got.collect()} == {("A", 1.5), (None, 2.0)}


def test_parquet_head_reads_only_its_columns(spark, sf):
    head = files.parquet_head(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_tax"], 5,
                              ["l_orderkey", "l_tax"])
    assert head.count() == 5
    assert "struct<l_orderkey:bigint,l_tax:double>" in str(scans_of(head))
    assert "TakeOrderedAndProject" in plan_of(head)


def test_lookup_takes_any_label(spark, rows):
    got = files.lookup(spark, {1: "it's", 2: 'a "b"'}, schemas.PAYMENT_LOOKUP)
    assert rows(got) == [(1, "it's"), (2, 'a "b"')]


def test_bucket_settings_name_the_key_file():
    conf = files.bucket_conf("/keys/k.json", "gcs.jar")
    assert conf["spark.jars"] == "gcs.jar"
    assert conf["spark.hadoop.fs.gs.auth.service.account.json.keyfile"] == "/keys/k.json"


# Writers --------------------------------------------------------------------------------------

def test_new_parquet_fails_when_present(spark, tmp_path):
    out.new_parquet(spark.range(1), str(tmp_path / "p"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        out.new_parquet(spark.range(1), str(tmp_path / "p"))


def test_single_file_keeps_parallel_aggregation(spark, tmp_path):
    out.single_file(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(),
                    str(tmp_path / "one"))
    assert len([n for n in names_in(tmp_path / "one") if n.endswith(".parquet")]) == 1


def test_typed_csv_goes_by_the_header_of_each_file(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    csv_file(tmp_path / "in" / "1.csv", "a,b", "1,x", "no,y")
    csv_file(tmp_path / "in" / "2.csv", "B,surplus,A", 'p,"q,r",7', ",,")
    with gzip.open(tmp_path / "in" / "3.csv.gz", "wt") as out_file:
        out_file.write("b\nonly\n")
    (tmp_path / "in" / "4.csv").write_text("")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = files.csv_typed(spark, str(tmp_path / "in"), schema, unparsed="bad")
    assert rows(got.select("a", "b", F.size("bad"))) == [
        (None, None, 0), (None, "only", 0), (None, "y", 1), (1, "x", 0), (7, "p", 0)]
    assert rows(got.where("size(bad) > 0").select(F.element_at("bad", 1))) == [("a",)]


def test_ingest_joins_uneven_months(spark, tmp_path):
    at = datetime(2019, 1, 5)
    def month(n, ddl, *values):
        spark.createDataFrame([values], ddl).write.parquet(
            files.month_path(str(tmp_path), "yellow", 2019, n))
    month(1, "tpep_pickup_datetime timestamp, passenger_count bigint, PULocationID int", at, 2, 7)
    month(2, "tpep_pickup_datetime timestamp, passenger_count double, airport_fee double",
          at, 3.0, 1.25)
    month(3, "TPEP_pickup_datetime timestamp, Passenger_Count double, Airport_fee double",
          at, None, 2.5)
    (tmp_path / files.MONTH_FILE.format(service="yellow", year=2019, month=4)).write_text("broken")
    got = files.ingest_months(spark, str(tmp_path), ["yellow"], "2019-01-01", "2019-05-31")
    found = got.trips.select("passenger_count", "pulocation_id", "airport_fee", "taxi_type")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(2, 7, None, "yellow"), (3, None, 1.25, "yellow"), (None, None, 2.5, "yellow")], key=str)
    assert [p[-15:] for p in got.skipped] == ["2019-04.parquet", "2019-05.parquet"]
    assert set(schemas.INGESTED.names) <= set(got.trips.columns)
    assert plan_of(got.trips).count("FileScan parquet") == 3


def test_csv_months_are_converted_once(spark, tmp_path):
    header = ",".join(schemas.GREEN_COLUMNS)
    for month in (1, 2):
        csv_file(tmp_path / "raw" / "green" / "2020" / f"{month:02d}" / "f.csv.gz", header,
                 f"2,2020-{month:02d}-05 10:00:00,2020-{month:02d}-05 10:05:00,N,1,7,8,1,1.5,"
                 "5.0,0,0.5,1.0,0,,0.3,6.8,1,1,0")
    args = (spark, str(tmp_path / "raw"), str(tmp_path / "pq"), "green")
    assert out.csv_months_to_parquet(*args, [(2020, 1)]) == ["2020-01"]
    assert out.csv_months_to_parquet(*args, [(2020, m) for m in (1, 2, 3)]) == ["2020-02"]
    assert out.csv_months_to_parquet(*args, [(2020, 1), (2020, 2)]) == []
    got = files.parquet(spark, str(tmp_path / "pq"))
    assert {(r.month, r.lpep_pickup_datetime.month, r.total_amount) for r in got.collect()} == {
        (1, 1, 6.8), (2, 2, 6.8)}


def test_landed_files_are_the_same_bytes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    csv_file(tmp_path / "in" / "a.csv", "p,i", '1,""', "2,", "3,é")
    with gzip.open(tmp_path / "in" / "b.csv.gz", "wt") as out_file:
        out_file.write("p,i\n" * 1000)
    (tmp_path / "in" / "c.csv").write_bytes(b"")
    for _ in range(2):
        assert out.copy_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw")) == 3
    assert sorted(os.listdir(tmp_path / "raw")) == ["a.csv", "b.csv.gz", "c.csv"]
    for name in os.listdir(tmp_path / "raw"):
        assert (tmp_path / "raw" / name).read_bytes() == (tmp_path / "in" / name).read_bytes()


def test_jdbc_and_warehouse_options(spark):
    options = out.jdbc_options("jdbc:postgresql://db/trips", "trips", "u", "p", 20_000, 4)
    assert options["batchsize"] == "20000" and options["numPartitions"] == "4"
    assert out.warehouse_options("reports.m", "tmp") == {
        "table": "reports.m", "temporaryGcsBucket": "tmp"}
    assert out.kafka_options("b:9092", "rides")["topic"] == "rides"
    with pytest.raises(ValueError):
        out.jdbc_writer(spark.range(1), "jdbc:x", "t", "ignore", "u", "p")


def test_table_comments_and_second_create(spark, tmp_path):
    name = table_name("c")
    for _ in range(2):
        tables.create_if_absent(spark, name, schemas.loaded("green"), str(tmp_path / name),
                                [loads.DATE])
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert comments["trip_type"] == "1 street hail, 2 dispatch"
    assert spark.table(name).columns == [*schemas.loaded("green").names, "pickup_date"]


def test_date_filters_prune_partitions(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, *[(i, i, "x") for i in range(10)]))
    table = spark.table(name)
    for df, n in ((date_range(table, "ts", "2020-01-03", "2020-01-05", "day"), 3),
                  (half_open(table, "ts", "2020-01-03 00:00:00", "2020-01-05 00:00:00", "day"), 2)):
        partition_filters = next(s for s in scans_of(df) if s.startswith("PartitionFilters"))
        assert "day" in partition_filters and df.count() == n


def test_clustered_table_prunes_buckets(spark, tmp_path):
    df = dated(spark, *[(i, i % 3, "x") for i in range(60)]).drop("day")
    name = table_name("clustered")
    table = tables.create_clustered(df, name, str(tmp_path / name), "ts", "k", 4, "day")
    one = table.where("k = 7")
    assert one.count() == 1
    # The planner hides the bucket list when no join needs the buckets, unless told not to.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(
            spark.table(name).where("k = 7")._jdf.queryExecution(), "formatted")
        assert "SelectedBucketsCount: 1 out of 4" in text
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def bytes_read(df):
    """Bytes taken from local files, and the rows found; vectored reads would not be counted."""
    spark = df.sparkSession
    counters = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    before = counters.get("file").getLong("bytesRead")
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    try:
        found = df.collect()
    finally:
        spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    return counters.get("file").getLong("bytesRead") - before, len(found)


def test_ranges_of_the_cluster_key_lower_the_bytes_read(spark, tmp_path):
    df = spark.range(120_000).select(
        "id", F.expr("if(id % 7 = 6, null, id % 7)").alias("k"),
        F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, id % 2)").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"))
    plain, ranged = table_name("by_day"), table_name("ranged")
    tables.create_partitioned(df, plain, str(tmp_path / plain), "ts", "day")
    tables.create_ranged(df, ranged, str(tmp_path / ranged), "ts", "k", "day")
    assert spark.table(ranged).columns == spark.table(plain).columns
    assert spark.table(ranged).exceptAll(spark.table(plain)).isEmpty()
    assert spark.table(plain).exceptAll(spark.table(ranged)).isEmpty()
    for where, rows in (("k = 2", 17_142), ("k >= 5", 17_142), ("k is null", 17_142)):
        query = f"day = date'2020-01-01' and {where}"
        whole, n = bytes_read(spark.table(plain).where(query).select("note"))
        some, m = bytes_read(spark.table(ranged).where(query).select("note"))
        assert n == m and abs(n - rows / 2) < 2
        assert some < 0.4 * whole


def test_a_hot_pair_and_copies_are_split_over_tasks(spark, tmp_path):
    name = table_name("ranged")
    copies = spark.range(0, 40_000, 1, 8).select(
        F.lit(1).alias("k"), F.lit("x").alias("note"), F.map_from_arrays(
            F.array(F.lit("a")), F.array(F.lit(1))).alias("tags"),
        F.expr("timestamp'2020-01-01'").alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = tables.create_ranged(copies, name, str(tmp_path / name), "ts", "k", "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert stored.count() == 40_000
    by_file = [r[1] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(by_file) >= 4 and max(by_file) <= 20_000


def test_ranges_of_an_empty_table(spark, tmp_path):
    name = table_name("ranged")
    empty = spark.createDataFrame([], "id long, k int, ts timestamp")
    assert tables.create_ranged(empty, name, str(tmp_path / name), "ts", "k", "day").count() == 0


def test_swap_may_read_its_own_table(spark, tmp_path, rows):
    name = table_name("s")
    tables.create_as(spark.range(4), name, str(tmp_path / name))
    tables.swap(spark.table(name).where("id > 1"), name)
    tables.swap(spark.table(name).withColumn("id", F.col("id") * 10), name)
    assert rows(spark.table(name)) == [(20,), (30,)]


def test_truncate_load_replaces(spark, tmp_path, rows):
    name = table_name("tl")
    tables.create_empty_like(spark.range(1), name, str(tmp_path / name))
    for n in (5, 2):
        tables.truncate_load(spark.range(n), name)
    assert rows(spark.table(name)) == [(0,), (1,)]


def test_add_columns(spark, tmp_path, rows):
    name = table_name("wide")
    tables.create_as(spark.createDataFrame([(1,)], "k int"), name, str(tmp_path / name))
    more = spark.createDataFrame([(2, "x")], "k int, v string")
    tables.add_columns(more, name)
    tables.append_rows(more, name)
    assert rows(spark.table(name)) == [(1, None), (2, "x")]


# Stored merges --------------------------------------------------------------------------------

def test_upsert_moves_a_row_between_partitions_and_drops_the_emptied_one(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, (1, 0, "old"), (2, 1, "old"), (3, 1, "old")))
    fresh = dated(spark, (1, 4, "new"), (3, 1, "new"), (9, 4, "new"))
    for _ in range(2):
        tables.upsert(fresh, name, ["k"], "day")
        assert keyed(spark, name) == [(1, 5, "new"), (2, 2, "old"), (3, 2, "new"), (9, 5, "new")]
    days = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert days == {"day=2020-01-02", "day=2020-01-05"}


def test_upsert_leaves_other_partitions_untouched(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, (1, 0, "old"), (2, 1, "old")))
    def day_files(day):
        return {f for f in spark.table(name).inputFiles() if f"day=2020-01-{day:02d}" in f}
    before = day_files(1)
    tables.upsert(dated(spark, (2, 1, "new")), name, ["k"], "day", key_fixes_partition=True)
    assert day_files(1) == before
    assert keyed(spark, name) == [(1, 1, "old"), (2, 2, "new")]


def test_upsert_into_empty_table_and_of_nothing(spark, tmp_path):
    name = table_name("e")
    empty = dated(spark).drop("day")
    tables.create_if_absent(spark, name, empty.schema, str(tmp_path / name),
                            [T.StructField("day", T.DateType())])
    tables.upsert(dated(spark, (1, 0, "a")), name, ["k"], "day")
    tables.upsert(dated(spark), name, ["k"], "day")
    assert keyed(spark, name) == [(1, 1, "a")]


def test_delete_insert_empties_a_partition(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, (1, 0, "old"), (2, 1, "old")))
    tables.delete_insert(dated(spark, (1, 2, "new"), (1, 2, "copy")), name, ["k"], "day")
    assert keyed(spark, name) == [(1, 3, "copy"), (1, 3, "new"), (2, 2, "old")]


def test_replace_interval_with_no_new_rows_deletes(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, *[(i, i, "old") for i in range(4)]))
    tables.replace_interval(dated(spark), name, "ts", "2020-01-02 00:00:00",
                            "2020-01-04 00:00:00", "day")
    assert keyed(spark, name) == [(0, 1, "old"), (3, 4, "old")]
    tables.replace_interval(dated(spark, (8, 1, "back")), name, "ts", "2020-01-02 00:00:00",
                            "2020-01-04 00:00:00", "day")
    assert keyed(spark, name) == [(0, 1, "old"), (3, 4, "old"), (8, 2, "back")]


def test_incremental_skips_old_rows_unless_looked_back_for(spark, tmp_path):
    name = table_name("inc")
    tables.create_if_absent(spark, name, dated(spark).drop("day").schema, str(tmp_path / name),
                            [T.StructField("day", T.DateType())])
    tables.incremental(dated(spark, (1, 0, "a"), (2, 3, "a")), name, "ts", ["k"], "day")
    late = dated(spark, (5, 2, "late"), (6, 4, "new"))
    tables.incremental(late, name, "ts", ["k"], "day")
    assert keyed(spark, name) == [(1, 1, "a"), (2, 4, "a"), (6, 5, "new")]
    tables.incremental(late, name, "ts", ["k"], "day", lookback=timedelta(days=3))
    assert keyed(spark, name) == [(1, 1, "a"), (2, 4, "a"), (5, 3, "late"), (6, 5, "new")]


def test_in_partitions_prunes_and_keeps_the_null_one(spark, tmp_path):
    rows = dated(spark, *[(i, i, "x") for i in range(6)])
    undated = rows.limit(1).withColumns({"ts": F.lit(None).cast("timestamp"),
                                         "day": F.lit(None).cast("date")})
    name = stored(spark, tmp_path, rows.unionByName(undated))
    wanted = dated(spark, (0, 1, ""), (0, 2, "")).unionByName(undated)
    few = tables.in_partitions(spark.table(name), "day", wanted)
    assert few.count() == 3
    assert "day" in next(s for s in scans_of(few) if s.startswith("PartitionFilters"))
    assert "Join" not in plan_of(few)


def undated(spark, *rows):
    """Rows of key and value without a date."""
    return spark.createDataFrame([(k, None, v, None) for k, v in rows],
                                 "k int, ts timestamp, v string, day date")


STRATEGIES = {
    "upsert": lambda rows, name: tables.upsert(rows, name, ["k"], "day"),
    "delete_insert": lambda rows, name: tables.delete_insert(rows, name, ["k"], "day"),
    "fixed": lambda rows, name: tables.upsert(rows, name, ["k"], "day",
                                              key_fixes_partition=True),
}


def held(spark, name):
    return sorted((r.k, r.day and r.day.day, r.v) for r in spark.table(name).collect())


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merges_of_many_partitions_leave_the_others(spark, tmp_path, strategy):
    old = dated(spark, *[(i, i % 25, "old") for i in range(75)])
    name = stored(spark, tmp_path, old)
    fresh = [(i, i % 25, "new") for i in range(75) if i % 25 < 14]
    STRATEGIES[strategy](dated(spark, *fresh), name)
    assert held(spark, name) == sorted(
        (i, i % 25 + 1, "new" if i % 25 < 14 else "old") for i in range(75))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merges_keep_rows_without_a_date(spark, tmp_path, strategy):
    before = dated(spark, (1, 0, "old"), (2, 1, "old")).unionByName(
        undated(spark, (3, "old"), (4, "old"), (5, "old")))
    name = stored(spark, tmp_path, before)
    for _ in range(2):
        STRATEGIES[strategy](undated(spark, (4, "new"), (9, "new")), name)
    assert held(spark, name) == [(1, 1, "old"), (2, 2, "old"), (3, None, "old"),
                                 (4, None, "new"), (5, None, "old"), (9, None, "new")]


def test_emptied_null_partition_is_dropped_and_stays_empty(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, (1, 0, "old")).unionByName(
        undated(spark, (2, "old"))))
    tables.upsert(dated(spark, (2, 0, "new")), name, ["k"], "day")
    assert held(spark, name) == [(1, 1, "old"), (2, 1, "new")]
    tables.append_rows(undated(spark, (7, "new")), name)
    assert held(spark, name) == [(1, 1, "old"), (2, 1, "new"), (7, None, "new")]


def test_deleted_rows_do_not_come_back_with_an_append(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, *[(i, i % 3, "old") for i in range(9)]))
    tables.replace_interval(dated(spark), name, "ts", "2020-01-02 00:00:00",
                            "2020-01-03 00:00:00", "day")
    tables.append_rows(dated(spark, (50, 1, "new")), name)
    assert held(spark, name) == sorted([(i, i % 3 + 1, "old") for i in range(9) if i % 3 != 1]
                                       + [(50, 2, "new")])


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_a_source_that_differs_when_read_twice_is_read_once(spark, tmp_path, strategy):
    name = stored(spark, tmp_path, dated(spark, *[(i, i, "old") for i in range(8)]))
    moving = spark.range(40).select(
        F.col("id").cast("int").alias("k"),
        F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, cast(rand() * 8 as int))")
        .alias("ts"), F.lit("new").alias("v")).withColumn("day", F.to_date("ts"))
    STRATEGIES[strategy](moving, name)
    found = held(spark, name)
    assert sorted(k for k, _, v in found if v == "new") == list(range(40))


def test_bound_reads_the_newest_partition(spark, tmp_path):
    name = stored(spark, tmp_path, dated(spark, *[(i, i, "x") for i in range(9)]).unionByName(
        undated(spark, (99, "x"))))
    assert tables.newest_in(spark, name, "ts", "day").date() == date(2020, 1, 9)
    bound = spark.table(name).where("day = date'2020-01-09'").agg(F.max("ts"))
    assert any("2020-01-09" in s for s in scans_of(bound) if s.startswith("PartitionFilters"))


def test_swaps_leave_one_former_version(spark, tmp_path):
    name = table_name("s")
    tables.create_as(spark.range(4), name, str(tmp_path / name))
    for n in (5, 6, 7):
        tables.swap(spark.range(n), name)
    assert spark.table(name).count() == 7
    kept = sorted(p.name for p in tmp_path.iterdir() if p.name.startswith(name))
    assert kept == [f"{name}-version-2", f"{name}-version-3"]


def test_load_file_twice_is_once(spark, tmp_path):
    header = ",".join(schemas.YELLOW_COLUMNS)
    line = "1,2020-01-01 10:00:00,2020-01-01 10:05:00,1,{},1,N,7,8,1,5.0,0,0.5,1.0,0,0.3,6.8,0"
    csv_file(tmp_path / "a.csv", header, line.format("1.5"), line.format("1.5"))
    csv_file(tmp_path / "b.csv", header, line.format("1.5"), line.format("2.5"))
    trips, staging = table_name("trips"), table_name("staging")
    loads.create_tables(spark, trips, staging, "yellow", str(tmp_path / trips),
                        str(tmp_path / staging))
    for name in ("a.csv", "a.csv", "b.csv"):
        loads.load_file(spark, str(tmp_path / name), trips, staging, "yellow", name)
    got = sorted((r.filename, r.trip_distance) for r in spark.table(trips).collect())
    assert got == [("a.csv", 1.5), ("a.csv", 1.5), ("b.csv", 2.5)]
    assert spark.table(trips).first().pickup_date == date(2020, 1, 1)


# Session --------------------------------------------------------------------------------------

def cluster(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.split(".")[1], default)),
        sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_workspace_follows_the_cluster_setting(spark):
    assert session.workspace(spark, "x") != session.workspace(spark, "x")
    named = cluster("spark://host:7077", checkpoint="hdfs://shared/spark/")
    assert session.workspace(named, "x").startswith("hdfs://shared/spark/x-")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.workspace(cluster("spark://host:7077"), "x")


def test_adapters_read_only_what_is_used(spark, sf):
    narrow = adapters.yellow(spark, sf).select("VendorID")
    assert [s for s in scans_of(narrow) if s.startswith("ReadSchema")] == [
        "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string>"]


class Stopped(Exception):
    pass


def stop_at(monkeypatch, wanted, count=1):
    """Commits stop when they have reached a step for the ``count``-th time."""
    seen = []

    def reached(step):
        seen.append(step)
        if seen.count(wanted) == count and seen[-1] == wanted:
            raise Stopped(step)
    monkeypatch.setattr(commits, "reached", reached)


def beside(tmp_path):
    """Everything kept for commits: manifests and folders of partitions."""
    return sorted(p.name for p in tmp_path.glob("*-commits/*"))


STEPS = ["opened", "written", "recorded", "added", "pointed", "set", "cleaned"]


@pytest.mark.parametrize("step", STEPS)
def test_a_merge_that_stops_at_any_step_has_old_or_new_rows(spark, tmp_path, step, monkeypatch):
    """One moves a row to a new day, one empties a day, one changes a day in place."""
    old = dated(spark, *[(i, i % 3, "old") for i in range(9)])
    name = stored(spark, tmp_path, old)
    before = held(spark, name)
    change = dated(spark, (0, 7, "new"), (3, 7, "new"), (6, 7, "new"), (1, 1, "new"))
    after = sorted([(0, 8, "new"), (3, 8, "new"), (6, 8, "new"), (1, 2, "new")]
                   + [r for r in before if r[0] not in (0, 3, 6, 1)])
    with monkeypatch.context() as patch:
        stop_at(patch, step)
        with pytest.raises(Stopped):
            tables.upsert(change, name, ["k"], "day")
    spark.catalog.refreshTable(name)
    if step in ("opened", "written", "recorded"):
        assert held(spark, name) == before
    commits.recover(spark, name)
    want = before if step in ("opened", "written") else after
    assert held(spark, name) == want
    assert not [n for n in beside(tmp_path) if "." in n]
    tables.upsert(change, name, ["k"], "day")
    assert held(spark, name) == after
    assert not [n for n in beside(tmp_path) if "." in n] and len(beside(tmp_path)) <= 2
    assert {d for d, in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {
        f"day=2020-01-{d:02d}" for d in (2, 3, 8)}


def test_a_recovery_may_stop_and_start_again(spark, tmp_path, monkeypatch):
    name = stored(spark, tmp_path, dated(spark, *[(i, i, "old") for i in range(4)]))
    for step in ("recorded", "added", "pointed", "set", "cleaned"):
        with monkeypatch.context() as patch:
            stop_at(patch, step)
            with pytest.raises(Stopped):
                if step == "recorded":
                    tables.upsert(dated(spark, (0, 5, "new"), (1, 1, "new")), name, ["k"], "day")
                else:
                    commits.recover(spark, name)
    commits.recover(spark, name)
    assert held(spark, name) == [(0, 6, "new"), (1, 2, "new"), (2, 3, "old"), (3, 4, "old")]
    assert not [n for n in beside(tmp_path) if "." in n]


def test_a_merge_is_evaluated_once(spark, tmp_path, monkeypatch):
    name = stored(spark, tmp_path, dated(spark, *[(i, i % 3, "old") for i in range(9)]))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = merge.upsert

    def counted(touched, source, keys):
        rows = plain(touched, source, keys)
        return rows.mapInArrow(count, rows.schema)
    monkeypatch.setattr(tables.merge, "upsert", counted)
    tables.upsert(dated(spark, (1, 1, "new")), name, ["k"], "day")
    assert seen.value == 3
    assert sum(r[2] == "new" for r in held(spark, name)) == 1


def test_merges_leave_no_copies_behind(spark, tmp_path, monkeypatch):
    root = tmp_path / "shared"
    monkeypatch.setattr("tripmill.session.shared_root", lambda spark: str(root))
    name = stored(spark, tmp_path, dated(spark, *[(i, i % 3, "old") for i in range(9)]))
    sizes = []
    for n in range(6):
        STRATEGIES["upsert"](dated(spark, (n, n % 3, f"v{n}")), name)
        sizes.append(len(list(tmp_path.rglob("*.parquet"))))
    assert not list(root.glob("merge-source*")) and len(set(sizes[2:])) == 1


def test_partition_values_with_quotes(spark, tmp_path):
    """Also signs that a directory name must escape."""
    rows = [(1, "it's"), (2, "a\\b"), (3, "x=y/z %41"), (4, None)]
    df = spark.createDataFrame(rows, "k int, place string")
    name = table_name("q")
    df.write.partitionBy("place").option("path", str(tmp_path / name)).saveAsTable(name)
    fresh = spark.createDataFrame([(1, "é 'q' \\"), (2, "a\\b"), (9, "it's not")],
                                  "k int, place string")
    for _ in range(2):
        tables.upsert(fresh, name, ["k"], "place")
    found = sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[0])
    assert found == [(1, "é 'q' \\"), (2, "a\\b"), (3, "x=y/z %41"), (4, None), (9, "it's not")]
    assert "it's" not in commits.directories(spark, name)


def test_headers_of_many_files_are_found_in_one_job(spark, tmp_path, monkeypatch):
    """Two thousand small files, some compressed, in three layouts, some empty."""
    import bz2
    lines = ["a,b\n1,2\n", "b,a\r\n2,1\r\n", "﻿a,\"c,d\"\n1,3\n"]
    for i in range(2000):
        raw = lines[i % 3].encode()
        if i % 50 == 0:
            (tmp_path / f"{i:04d}.csv.gz").write_bytes(gzip.compress(raw))
        elif i % 50 == 1:
            (tmp_path / f"{i:04d} x.csv.bz2").write_bytes(bz2.compress(raw))
        else:
            (tmp_path / f"{i:04d}.csv").write_bytes(raw)
    (tmp_path / "none.csv").write_bytes(b"")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = files.csv_headers(spark, str(tmp_path))
        jobs = tracker.getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert {k: len(v) for k, v in found.items()} == {
        ("a", "b"): 667, ("b", "a"): 667, ("a", "c,d"): 666}
    assert len(jobs) <= 4
    rows = files.csv_typed(spark, str(tmp_path), T.StructType.fromDDL("a int, b int"))
    assert rows.groupBy("a", "b").count().orderBy("b").collect() == [(1, None, 666), (1, 2, 1334)]


def test_headers_of_other_compressions_come_through_spark(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1)
    path = str(tmp_path / "d")
    df.write.option("header", True).option("compression", "deflate").csv(path)
    assert list(files.csv_headers(spark, path)) == [("a", "b")]


def test_footers_are_read_in_one_job_and_lost_stores_are_errors(spark, tmp_path, monkeypatch):
    from tripmill.sources import heads
    for m in range(1, 13):
        kind = "bigint" if m % 2 else "int"
        spark.range(m).selectExpr(f"cast(id as {kind}) AS VendorID").write.parquet(
            str(tmp_path / f"yellow_tripdata_2023-{m:02d}.parquet"))
    (tmp_path / "yellow_tripdata_2024-01.parquet").write_bytes(b"PAR1 but not really")
    (tmp_path / "yellow_tripdata_2024-02.parquet").mkdir()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        found = files.ingest_months(spark, str(tmp_path), ["yellow"], "2023-01-01", "2024-03-01")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert [p[-15:-8] for p in found.skipped] == ["2024-01", "2024-02", "2024-03"]
    assert found.rows == found.trips.count() == sum(range(1, 13))
    assert len(jobs) <= 4  # one for the footers, one for each distinct schema

    def lost(path):
        raise ConnectionError(path)
    monkeypatch.setattr(heads, "opened", lost)
    with pytest.raises(ConnectionError):
        heads._footer("file:/x")


def test_landing_manifest_and_second_run(spark, tmp_path):
    """Subfolders, digests, and a retry that copies only what is not there in full."""
    import hashlib
    source, raw = tmp_path / "in", tmp_path / "raw"
    (source / "2020" / "01").mkdir(parents=True)
    content = {"a.csv": b"x\n1\n", "2020/01/b.csv": b"\x00\xff" * 70_000, "2020/c d.csv": b"",
               "_hidden/x": b"no", "2020/.tmp": b"no"}
    (source / "_hidden").mkdir()
    for name, data in content.items():
        (source / name).write_bytes(data)
    want = {(n, len(d), hashlib.sha256(d).hexdigest()) for n, d in content.items()
            if "_" not in n and "." != n.split("/")[-1][0]}

    def run():
        rows = out.land(spark, str(source), str(raw)).collect()
        assert {(r.file, r.length, r.sha256) for r in rows} == want
        return {r.file for r in rows if not r.kept}
    assert run() == {w[0] for w in want}
    assert run() == set()
    (raw / "a.csv").write_bytes(b"x\n9\n")
    (raw / "2020" / "01" / "b.csv").write_bytes(b"torn")
    assert run() == {"a.csv", "2020/01/b.csv"}
    assert all((raw / n).read_bytes() == content[n] for n, _, _ in want)
