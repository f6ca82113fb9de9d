from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, scans_of
from tripmill import schemas
from tripmill.operators import (
    aggregates, dedupe, filters, joins, keyfilter, merge, partitions, projections, quality, skew)
from tripmill.plans import layers, loads, revenue, star
from tripmill.session import table_name
from tripmill.sinks import tables
from tripmill.sources import adapters, files

NOON = datetime(2020, 1, 1, 12, 0, 0)


def small_trips(spark):
    """Null vendor, null and unknown payment, unmatched zone, an exact copy and a tie."""
    columns = ("VendorID int, pickup_datetime timestamp, dropoff_datetime timestamp, "
               "PULocationID int, DOLocationID int, payment_type int, fare_amount double, "
               "total_amount double, service_type string")
    late = NOON + timedelta(minutes=5)
    return spark.createDataFrame([
        (None, NOON, late, 1, 2, 1, 5.0, 6.0, "green"),
        (1, NOON, late, 1, 2, None, 5.0, 6.0, "green"),
        (1, NOON, late, 1, 2, None, 5.0, 6.0, "green"),
        (1, NOON, late, 1, 99, 9, 5.0, 7.5, "green"),
        (2, NOON, NOON + timedelta(seconds=1), 1, 2, 2, 0.0, 0.0, "yellow"),
        (2, NOON + timedelta(days=40), late, 99, 2, 3, 1.25, 2.5, "yellow"),
    ], columns)


def test_tagged_union_matches_by_name(spark, rows):
    left = spark.createDataFrame([(1, 2.0, 3)], "a int, b double, only_left int")
    right = spark.createDataFrame([(20.0, 10)], "b double, a int")
    both = projections.tagged_union({"l": left, "r": right}, "side")
    assert both.columns == ["a", "b", "side"]
    assert rows(both) == [(1, 2.0, "l"), (10, 20.0, "r")]


def test_common_columns_keep_left_order(spark, sf):
    green = projections.common_names(adapters.green(spark, sf))
    yellow = projections.common_names(adapters.yellow(spark, sf))
    assert projections.common_columns(green, yellow) == schemas.COMMON_COLUMNS


def test_drop_by_column_keeps_same_name_in_other_case(spark):
    left = spark.createDataFrame([(1,)], "zone int")
    right = spark.createDataFrame([(1, "Astoria")], "LocationID int, Zone string")
    joined = left.join(right, left["zone"] == right["LocationID"])
    kept = projections.drop_columns(joined, left["zone"], right["LocationID"])
    assert kept.columns == ["Zone"] and kept.first().Zone == "Astoria"


def test_keep_or_default(spark):
    df = spark.createDataFrame([("x", 1.0), (None, None)], "brand string, price double")
    got = projections.keep_or_default(df, ["brand", "price", "sku"]).collect()
    assert [tuple(r) for r in got] == [("x", 1.0, "N/A"), ("N/A", None, "N/A")]


def test_cast_all_strict_and_lenient(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    schema = spark.createDataFrame([], "a int, b int").schema
    assert [tuple(r) for r in projections.cast_all(df, schema, strict=False).collect()] == [
        (1, None), (2, 3)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        projections.cast_all(df, schema).collect()


def test_half_open_bounds(spark):
    df = spark.createDataFrame([(NOON,), (NOON + timedelta(hours=1),), (None,)], "ts timestamp")
    got = filters.half_open(df, "ts", "2020-01-01 12:00:00", "2020-01-01 13:00:00").collect()
    assert [r.ts for r in got] == [NOON]


def test_newer_than_empty_target_and_lookback(spark):
    source = spark.createDataFrame([(NOON,), (NOON + timedelta(hours=2),)], "ts timestamp")
    empty = source.limit(0)
    target = spark.createDataFrame([(NOON + timedelta(hours=1),)], "ts timestamp")
    assert filters.newer_than(source, empty, "ts").count() == 2
    assert filters.newer_than(source, target, "ts").count() == 1
    assert filters.newer_than(source, target, "ts", timedelta(hours=1)).count() == 1
    assert filters.newer_than(source, target, "ts", timedelta(hours=1, seconds=1)).count() == 2


def test_newer_than_has_no_join_and_is_pushed(spark, sf):
    trips = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = plan_of(filters.newer_than(trips, trips.where("l_quantity > 3"), "l_shipdate"))
    assert "Join" not in plan and "GreaterThan(l_shipdate,ScalarSubquery" in plan


def test_sized_broadcasts_only_small(spark):
    facts = spark.range(1000)
    dim = spark.range(100).withColumnRenamed("id", "k").repartition(2)
    small = joins.lookup_join(facts, dim, F.col("id") == F.col("k"), "inner")
    assert "BroadcastHashJoin" in plan_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup_join(facts, dim, F.col("id") == F.col("k"), "inner", max_rows=99)
        assert "SortMergeJoin" in plan_of(large)
        assert large.count() == small.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_anti_insert_null_keys_never_match(spark, rows):
    source = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    target = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(skew.anti_insert(source, target, ["k"])) == [(None, "b"), (2, "c")]


def hot_frames(spark):
    """Most source rows share one key or have none; a copy of the hot key may be in the target."""
    source = spark.range(10_000).select(
        F.when(F.col("id") % 10 < 5, "hot").when(F.col("id") % 10 < 8, None)
        .otherwise(F.col("id").cast("string")).alias("k"), "id")
    target = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    return source, target


def test_hot_keys_are_found_and_rare_ones_are_not(spark):
    source, _ = hot_frames(spark)
    assert len(skew.hot_hashes(source, ["k"], min_rows=100)) == 2
    assert skew.hot_hashes(source, ["k"]) == []
    assert skew.hot_hashes(source.limit(0), ["k"], min_rows=1) == []


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("with_hot", [True, False])
def test_filter_join_is_exact_on_hot_keys(spark, how, with_hot):
    source, target = hot_frames(spark)
    if not with_hot:
        target = target.where("k <> 'hot'")
    split = skew.filter_join(source, target, ["k"], how, min_rows=100)
    plain = source.join(target, ["k"], how)
    assert "BroadcastHashJoin" in plan_of(split)
    assert split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0


def test_hot_rows_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source, target = hot_frames(spark)
        plan = plan_of(skew.filter_join(source, target, ["k"], "left_anti", min_rows=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cold, hot = plan.split("BroadcastHashJoin")
    assert "SortMergeJoin" in cold
    left_of_broadcast = hot.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in left_of_broadcast


def test_full_outer_coalesces_keys(spark, rows):
    left = spark.createDataFrame([(1, 1, 10)], "h int, z int, g int")
    right = spark.createDataFrame([(2, 1, 20), (1, 1, 30)], "h int, z int, y int")
    assert rows(joins.full_outer(left, right, ["h", "z"])) == [(1, 1, 10, 30), (2, 1, None, 20)]


def test_keep_first_limits_groups_before_the_shuffle(spark, sf):
    trips = adapters.trips(spark, sf)
    plan = plan_of(dedupe.keep_first(trips, ["PULocationID"], ["pickup_datetime"]))
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_keep_first_on_a_group_with_most_rows(spark):
    """Most rows share one key; the result is still exact."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id")).alias("k"), "id")
    got = dedupe.keep_first(df, ["k"], [F.desc("id")])
    assert got.count() == 6001
    assert got.where("k = 0").first().id == 19_996


def test_qualify_leaves_no_helper_column(spark):
    assert dedupe.keep_first(spark.range(3), ["id"], ["id"]).columns == ["id"]


def test_monthly_revenue_by_hand(spark):
    trips = small_trips(spark).withColumns({
        c: F.lit(None).cast("double") for c in
        ("extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
         "congestion_surcharge", "trip_distance")}).withColumn("passenger_count", F.lit(2))
    got = {(r.revenue_zone, str(r.revenue_month)[:7], r.service_type): r
           for r in aggregates.monthly_revenue(trips).collect()}
    assert set(got) == {(1, "2020-01", "green"), (1, "2020-01", "yellow"), (99, "2020-02", "yellow")}
    green = got[(1, "2020-01", "green")]
    assert green.revenue_monthly_fare == 20.0 and green.revenue_monthly_total_amount == 25.5
    assert green.revenue_monthly_extra is None and green.avg_monthly_passenger_count == 2.0


def test_hourly_revenue_equals_classic_reduce(spark, sf):
    """The declarative report, the batch reduce and a plain keyed reduce agree to the last digit."""
    green = adapters.green(spark, sf)
    since = datetime(1998, 1, 1)
    pairs = (green.select("lpep_pickup_datetime", "PULocationID", "total_amount").rdd
             .filter(lambda r: r.lpep_pickup_datetime >= since)
             .map(lambda r: ((r.lpep_pickup_datetime.replace(minute=0, second=0, microsecond=0),
                              r.PULocationID), (round(r.total_amount * 10_000), 1)))
             .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]))
             .map(lambda kv: (*kv[0], kv[1][0] / 10_000, kv[1][1])).collect())
    declared = aggregates.hourly_revenue(green, "1998-01-01", "lpep_pickup_datetime").collect()
    reduced = partitions.revenue_by_reduce(green, "1998-01-01", "lpep_pickup_datetime").collect()
    assert sorted(pairs) == sorted(map(tuple, declared)) == sorted(map(tuple, reduced))


def test_reduce_ignores_null_amounts_like_sql(spark, rows):
    df = spark.createDataFrame(
        [(NOON, 1, None), (NOON, 1, 2.5), (NOON, 2, None), (None, 1, 4.0)],
        "lpep_pickup_datetime timestamp, PULocationID int, total_amount double")
    want = rows(aggregates.hourly_revenue(df, "2019-01-01", "lpep_pickup_datetime"))
    assert rows(partitions.revenue_by_reduce(df, "2019-01-01", "lpep_pickup_datetime")) == want
    assert [r[2:] for r in want] == [(2.5, 2), (None, 1)]


def test_has_rows(spark):
    assert aggregates.has_rows(spark.range(5)).first()[0] == 1
    assert aggregates.has_rows(spark.range(0)).first()[0] == 0


def test_distinct_count_forms(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert aggregates.distinct_count(df, "k").first()[0] == 100
    assert abs(aggregates.distinct_count(df, "k", approximate=True).first()[0] - 100) <= 3


def test_aggregates_combine_before_the_shuffle(spark, sf):
    plan = plan_of(revenue.monthly(adapters.green(spark, sf), adapters.yellow(spark, sf)))
    assert "partial_sum" in plan.split("Exchange hashpartitioning")[1]
    assert plan.count("Exchange") == 1
    assert "Python" not in plan


def test_hourly_join_reuses_the_aggregate_shuffle(spark, sf):
    joined = revenue.hourly_by_service(
        adapters.green(spark, sf, dated=True), adapters.yellow(spark, sf, dated=True),
        "1998-01-01", "pickup_date")
    assert plan_of(joined).count("Exchange hashpartitioning") == 2
    pushed = [line for line in scans_of(joined) if line.startswith("PushedFilters")]
    assert len(pushed) == 2 and all("GreaterThanOrEqual(l_shipdate" in p for p in pushed)


def test_star_chain_by_hand(spark):
    raw = small_trips(spark).drop("service_type").withColumns({
        "RatecodeID": F.lit(1), "store_and_fwd_flag": F.lit("N"), "passenger_count": F.lit(1),
        "trip_type": F.lit(2), **{c: F.lit(1.2345) for c in (
            "trip_distance", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
            "improvement_surcharge")}})
    green = raw.where("VendorID is null or VendorID = 1")
    yellow = raw.where("VendorID = 2").drop("trip_type", "ehail_fee")
    zones = spark.createDataFrame([(1, "Queens", "Astoria", "Boro Zone"),
                                   (2, "Bronx", "Norwood", "Boro Zone")], schemas.ZONES)
    fact = star.build_fact(green, yellow, files.payment_descriptions(spark), zones)
    assert fact.columns == star.FACT_COLUMNS
    found = {(r.vendorid, r.pickup_locationid): r for r in fact.collect()}
    assert set(found) == {(1, 1), (2, 1), (2, 99)}
    first = found[(1, 1)]
    assert (first.payment_type, first.payment_type_description) == (0, "Unknown")
    assert (first.pickup_zone, first.dropoff_zone, first.trip_duration_minutes) == (
        "Astoria", "Norwood", 5)
    assert str(first.tip_amount) == "1.235" and first.service_type == "Green"
    other = found[(2, 99)]
    assert other.pickup_zone is None and other.dropoff_zone == "Norwood"
    assert (other.trip_type, str(other.ehail_fee), other.service_type) == (1, "0.000", "Yellow")
    assert other.payment_type_description == "No charge"
    unioned = star.trips_unioned(star.staging(green, "green"), star.staging(yellow, "yellow"))
    enriched = star.enriched_trips(unioned, files.payment_descriptions(spark))
    known = star.fact_trips(enriched, zones, known_zones_only=True, years=(2020, 2020))
    assert known.count() == 2


def test_unknown_payment_code_has_a_label(spark, rows):
    trips = small_trips(spark).where("payment_type = 9")
    dim = files.payment_descriptions(spark)
    joined = joins.lookup_join(trips, dim, ["payment_type"])
    assert joined.select(F.coalesce("description", F.lit("Unknown"))).first()[0] == "Unknown"


def test_enriched_trip_ids_are_unique(spark, sf):
    unioned = star.trips_unioned(star.staging(adapters.green(spark, sf), "green"),
                                 star.staging(adapters.yellow(spark, sf), "yellow"))
    enriched = star.enriched_trips(unioned, files.payment_descriptions(spark))
    checks = quality.report(enriched, [
        quality.not_null("trip_id"), quality.not_null("vendorid"),
        quality.accepted_values("service_type", ["Green", "Yellow"]),
        quality.not_null("total_amount")], [["trip_id"]])
    assert all(r.passed for r in checks.collect())


def test_layers_report(spark, sf):
    staged = layers.staged_trips(adapters.ingested(spark, sf), files.payment_names(spark),
                                 "1998-01-01", "1999-01-01")
    report = layers.trips_report(staged, "1998-01-01", "1999-01-01")
    assert report.agg(F.sum("trip_count")).first()[0] == staged.count()


def test_stage_sets_id_and_file_on_every_row(spark, sf):
    staged = loads.stage(adapters.yellow(spark, sf), "yellow", "f.csv")
    assert staged.schema.names == schemas.loaded("yellow").names
    assert staged.where("unique_row_id is null or filename <> 'f.csv'").count() == 0


# Merge expressions ----------------------------------------------------------------------------

def merge_frames(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    source = spark.createDataFrame([(2, "new", 7), (3, "new", 8), (3, "newer", 9)],
                                   "k int, v string, extra int")
    return target, source


def test_insert_only_keeps_copies_unless_told(spark, rows):
    target, source = merge_frames(spark)
    kept = merge.insert_only(target, source, ["k"])
    assert rows(kept) == [(1, "old", None), (2, "old", None), (3, "new", 8), (3, "newer", 9)]
    once = merge.insert_only(target, source, ["k"], dedupe_source=True, order=["k", "extra"])
    assert rows(once) == [(1, "old", None), (2, "old", None), (3, "new", 8)]


def test_insert_only_into_empty_target(spark):
    target, source = merge_frames(spark)
    assert merge.insert_only(target.limit(0), source, ["k"]).count() == 3


def test_upsert_twice_is_once(spark, rows):
    target, source = merge_frames(spark)
    once = merge.upsert(target, source, ["k"], [F.desc("extra")])
    assert rows(once) == [(1, "old", None), (2, "new", 7), (3, "newer", 9)]
    assert rows(merge.upsert(once, source, ["k"], [F.desc("extra")])) == rows(once)


def test_delete_insert_keeps_source_copies(spark, rows):
    target, source = merge_frames(spark)
    assert rows(merge.delete_insert(target, source, ["k"])) == [
        (1, "old", None), (2, "new", 7), (3, "new", 8), (3, "newer", 9)]


def test_replace_interval_bounds(spark, rows):
    def at(*hours):
        return spark.createDataFrame([(NOON + timedelta(hours=h), v) for h, v in hours],
                                     "ts timestamp, v string")
    target = at((0, "old"), (1, "old"), (2, "old"))
    source = at((0, "new"), (1, "new"), (2, "new"))
    got = merge.replace_interval(target, source, "ts", "2020-01-01 13:00:00",
                                 "2020-01-01 14:00:00")
    assert [v for _, v in rows(got)] == ["old", "new", "old"]


def test_append_new_columns(spark, rows):
    target, source = merge_frames(spark)
    assert rows(merge.append_new_columns(target, source))[0] == (1, "old", None)


# Checks ---------------------------------------------------------------------------------------

def test_each_check_can_fail(spark):
    bad = spark.createDataFrame([(None, "a", -1), (1, "b", 0), (1, "z", 2)],
                                "k int, v string, n int")
    got = {(r.check_name, r.column_name): (r.failures, r.passed) for r in quality.report(
        bad, [quality.not_null("k"), quality.accepted_values("v", ["a", "b"]),
              quality.positive("n"), quality.non_negative("n")], [["k"], ["k", "v"]]).collect()}
    assert got == {("not_null", "k"): (1, False), ("accepted_values", "v"): (1, False),
                   ("positive", "n"): (2, False), ("non_negative", "n"): (1, False),
                   ("unique", "k"): (1, False), ("unique", "k,v"): (0, True)}


def test_custom_query_passes_and_fails(spark):
    for n, passed in ((0, False), (2, True)):
        row = quality.custom_query(spark, "rows", "SELECT count(*) > 0 FROM {t}", True,
                                   t=spark.range(n)).first()
        assert row.passed is passed


def test_row_checks_read_the_table_once(spark, sf):
    trips = adapters.trips(spark, sf)
    plan = plan_of(quality.row_checks(trips, [
        quality.not_null("VendorID"), quality.positive("fare_amount"),
        quality.non_negative("tip_amount")]))
    assert plan.count("FileScan") == 1


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(quality.profile(df)) == [("a", "int", 2, 2), ("b", "string", 1, 2)]


def test_predict_batches_adds_one_column(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, trip_distance double")
    got = partitions.predict_batches(df, partitions.distance_times_five).collect()
    assert [tuple(r) for r in got] == [(1, 2.0, 10.0), (2, None, None)]


def test_key_filter_keeps_every_match_and_little_else(spark):
    source = spark.range(0, 3000, 3).selectExpr("id AS a", "CAST(id % 7 AS STRING) AS b")
    target = spark.range(200_000).selectExpr("id AS a", "CAST(id % 7 AS STRING) AS b",
                                             "id AS payload")
    found = keyfilter.likely(target, source, ["a", "b"])
    assert found.join(source, ["a", "b"], "left_semi").count() == 1000
    assert found.count() <= 1000 + 0.02 * 200_000
    assert keyfilter.likely(target, source.limit(0), ["a", "b"]).count() == 0
    nulls = target.withColumn("b", F.lit(None).cast("string"))
    assert keyfilter.likely(nulls, source.union(nulls.select("a", "b")), ["a", "b"]).count() == 0
    assert "Python" not in plan_of(found) and "Join" not in plan_of(found)


def test_key_filter_size_is_bounded():
    assert keyfilter.words_for(0) == keyfilter.FEWEST_WORDS
    assert 64 * keyfilter.words_for(100_000) >= keyfilter.BITS_PER_KEY * 100_000
    assert keyfilter.words_for(10 ** 12) == keyfilter.MOST_WORDS


def test_insert_new_with_a_filter_full_of_wrong_keys(spark, tmp_path, monkeypatch):
    """With every bit set, all target rows pass the filter; the join alone decides."""
    monkeypatch.setattr(keyfilter, "FEWEST_WORDS", 1)
    monkeypatch.setattr(keyfilter, "MOST_WORDS", 1)
    name = table_name("insert")
    tables.create_as(spark.range(0, 500).withColumn("v", F.lit("old")), name,
                     str(tmp_path / name))
    source = spark.range(400, 900).withColumn("v", F.lit("new"))
    assert keyfilter.likely(spark.table(name), source, ["id"]).count() == 500
    for _ in range(2):
        tables.insert_new(source, name, ["id"])
    got = spark.table(name).groupBy("v").agg(F.count("*"), F.min("id")).collect()
    assert sorted(map(tuple, got)) == [("new", 400, 500), ("old", 500, 0)]


def test_insert_new_shuffles_as_many_target_rows_as_the_source_has(spark, tmp_path):
    name = table_name("insert")
    tables.create_as(spark.range(0, 300_000), name, str(tmp_path / name))
    source = spark.range(299_000, 301_000)
    known = keyfilter.likely(spark.table(name), source, ["id"])
    assert 1000 <= known.count() <= 1000 + 0.02 * 300_000
    tables.insert_new(source, name, ["id"])
    assert spark.table(name).count() == 301_000


def test_profile_shows_the_first_rows(spark, rows):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "a int, b string")
    assert rows(quality.profile(df, 2)) == [("a", "int", 3, 3, "1 | 2"),
                                            ("b", "string", 2, 3, "NULL | b")]
    assert [r["head"] for r in quality.profile(df.limit(0), 2).collect()] == ["", ""]


def test_sums_by_ordinal_and_by_reduce_keep_fine_values_and_nan(spark):
    at = datetime(2020, 1, 1, 5)
    nan = float("nan")
    df = spark.createDataFrame(
        [(at, 1, 0.00001), (at, 1, 0.00002), (at, 2, 1.5), (at, 2, nan), (at, 3, None), (at, 4, 1e300)],
        "t timestamp, PULocationID int, total_amount double")
    found = {r["zone"]: r["revenue"] for r in
             partitions.revenue_by_reduce(df, "2019-01-01", "t").collect()}
    assert found[1] == pytest.approx(0.00003) and found[4] == 1e300
    assert found[2] != found[2] and found[3] is None
    from tripmill.functions.exact import exact_sum, exact_sum_sql
    by_sql = spark.sql(f"SELECT PULocationID AS z, {exact_sum_sql('total_amount')} AS s "
                       "FROM {df} GROUP BY 1", df=df)
    plain = df.groupBy("PULocationID").agg(exact_sum("total_amount").alias("s"))
    assert sorted(map(str, by_sql.collect())) == sorted(
        map(str, plain.withColumnRenamed("PULocationID", "z").collect()))
