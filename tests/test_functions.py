from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripmill.functions import exact, keys, labels, temporal


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ts(text):
    return F.lit(text).cast("timestamp")


def test_minutes_count_boundaries(spark):
    row = one(spark, across=temporal.minutes_between(ts("2020-01-01 10:00:59"),
                                                     ts("2020-01-01 10:01:01")),
              within=temporal.minutes_between(ts("2020-01-01 10:00:00"),
                                              ts("2020-01-01 10:00:59")),
              back=temporal.minutes_between(ts("2020-01-01 10:01:01"),
                                            ts("2020-01-01 10:00:59")),
              early=temporal.minutes_between(ts("1969-12-31 23:59:30"),
                                             ts("1970-01-01 00:00:10")))
    assert (row.across, row.within, row.back, row.early) == (1, 0, -1, 1)


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 1e9, 0.2, -1e9, 0.3, None]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "x double").repartition(3)
        row = df.agg(exact.exact_sum("x").alias("s"), exact.exact_avg("x").alias("m")).first()
        assert row.s == 0.6 and row.m == 0.6 / 5


def test_exact_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(exact.exact_sum("x").alias("s")).first().s is None


def test_number_text_is_shortest_form(spark):
    texts = {10.0: "10", 12.5: "12.5", 0.0: "0", 100.25: "100.25", 1e7: "10000000", -3.1: "-3.1"}
    for value, text in texts.items():
        assert one(spark, t=keys.number_text(F.lit(value))).t == text


def test_row_hash_treats_null_as_empty(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    row = df.select(keys.row_hash(["a", "b", "c"]).alias("hex"),
                    keys.row_hash_bytes(["a", "b", "c"]).alias("raw")).first()
    assert row.hex == hashlib.md5(b"1x").hexdigest()
    assert bytes(row.raw) == hashlib.md5(b"1x").digest()


def test_surrogate_key_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "p string, q string")
    found = [r.k for r in df.select(keys.surrogate_key(["p", "q"]).alias("k")).collect()]
    assert found[0] != found[1]
    assert found[0] == hashlib.md5(f"a-{keys.NULL_TOKEN}".encode()).hexdigest()


def python_base_id(text):
    number = int(text[1:])
    prefix = "s" if number % 7 == 0 else "a" if number % 3 == 0 else "e"
    return f"{prefix}/{number:03x}"


def test_base_id_known_and_unreadable(spark):
    df = spark.createDataFrame([("B02884",), (None,), ("Bxyz",), ("B",)], "b string")
    for fn in (labels.base_id, labels.base_id_udf):
        got = [r.i for r in df.select(fn("b").alias("i")).collect()]
        assert got == ["s/b44", None, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 99_999_999), min_size=1, max_size=50))
def test_base_id_forms_agree(spark, numbers):
    df = spark.createDataFrame([(f"B{n:05d}",) for n in numbers], "b string")
    for row in df.select("b", labels.base_id("b").alias("x"),
                         labels.base_id_udf("b").alias("y")).collect():
        assert row.x == row.y == python_base_id(row.b)


def test_labels(spark):
    df = spark.createDataFrame([(1,), (3,), (9,), (None,)], "k int")
    got = [(r.p, r.v) for r in df.select(labels.payment_label("k").alias("p"),
                                         labels.vendor_label("k").alias("v")).collect()]
    assert got == [("Credit Card", "Creative Mobile Technologies"), ("No charge", None),
                   ("Other", None), ("Other", None)]


def test_parse_timestamp(spark):
    row = one(spark, good=temporal.parse_timestamp(F.lit("2020-02-29 23:59:59")),
              bad=temporal.parse_timestamp(F.lit("2021-02-29 00:00:00")),
              pattern=temporal.parse_timestamp(F.lit("29/02/2020"), "dd/MM/yyyy"))
    assert row.good == datetime(2020, 2, 29, 23, 59, 59)
    assert row.bad is None and row.pattern == datetime(2020, 2, 29)


def test_epoch_round_trip(spark):
    row = one(spark, ts=temporal.from_epoch_ms(F.lit(1730429702000)),
              ms=temporal.to_epoch_ms(ts("2024-11-01 02:55:02.999999")))
    assert row.ts == datetime(2024, 11, 1, 2, 55, 2) and row.ms == 1730429702999


def test_months_step_on_month_starts(spark):
    got = [str(r.month) for r in temporal.months(spark, "2023-11-30", "2024-02-01").collect()]
    assert got == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    assert temporal.month_list("2023-11-30", "2024-02-01") == [
        (2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert temporal.month_list("2024-02-01", "2024-01-31") == []


@pytest.mark.parametrize("label,want", [("2020-01-05", "2020-01"), ("1999-12-31", "1999-12")])
def test_month_label(spark, label, want):
    assert one(spark, m=temporal.month_label(F.lit(label).cast("date"))).m == want


def test_exact_sums_of_finer_values_and_of_nan(spark):
    from tripmill.functions.exact import exact_avg, exact_sum
    df = spark.range(100_000).select(F.lit(0.00004).alias("v"), F.lit(0.1).alias("m"))
    row = df.agg(exact_sum("v"), exact_avg("v"), exact_sum("m")).first()
    assert row[0] == pytest.approx(4.0, rel=1e-12) and row[1] == pytest.approx(0.00004, rel=1e-12)
    assert row[2] == 10_000.0
    odd = spark.createDataFrame([(1.0, float("nan")), (2.0, 1e300), (None, 1.5)],
                                "a double, b double")
    a, b = odd.agg(exact_sum("a"), exact_sum("b")).first()
    assert a == 3.0 and b != b
    assert odd.where("b > 1e200 AND b = b").agg(exact_sum("b")).first()[0] != 0
    assert odd.where("false").agg(exact_sum("a")).first()[0] is None


def test_number_text_keeps_every_digit(spark):
    from tripmill.functions.keys import number_text
    values = [12.5, 10.0, 0.0, 0.00004, -3.25, 1.23456, 1e7, 1e30, None, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(number_text("v")).collect()] == [
        "12.5", "10", "0", "0.00004", "-3.25", "1.23456", "10000000", "1.0E30", None,
        "0.30000000000000004"]
