from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tripmill.operators import regression as reg, selection


def of(spark, values):
    return selection.medians(spark.createDataFrame([(v,) for v in values], "v double"), ["v"])["v"]


@pytest.mark.parametrize("buckets", [2, 7, 1 << 14])
def test_medians_are_exact(spark, monkeypatch, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    rnd = random.Random(buckets)
    for n in (1, 2, 9, 40):
        values = [rnd.choice([rnd.uniform(-5, 5), float(rnd.randint(-2, 2)), 1e-9, 3e5]) for _ in range(n)]
        assert of(spark, values) == statistics.median(values)


def test_medians_of_odd_columns(spark):
    inf, nan = float("inf"), float("nan")
    assert of(spark, []) is None and of(spark, [None, None]) is None
    assert of(spark, [None, 3.0]) == 3.0 and of(spark, [4.0] * 5000) == 4.0
    assert of(spark, [-1.7e308, 0.0, 1.7e308]) == 0.0
    assert of(spark, [-inf, -inf, 1.0]) == -inf and of(spark, [1.0, inf, inf]) == inf
    assert of(spark, [1.0, inf, nan]) == inf and of(spark, [1.0, 2.0, nan, nan, nan]) != 2.0
    both = spark.range(1001).select(F.col("id").cast("double").alias("a"),
                                    (F.col("id") % 3).alias("b"))
    assert selection.medians(both, ["a", "b"]) == {"a": 500.0, "b": 1.0}


def test_a_hot_value_takes_few_passes(spark, monkeypatch):
    """A third of the rows share one value; the rest spread over many orders of magnitude."""
    passes, plain = [], selection._narrow
    monkeypatch.setattr(selection, "_narrow",
                        lambda *args: passes.append(1) or plain(*args))
    values = [5.0] * 3000 + [10.0 ** (i % 30) + i for i in range(6001)]
    assert of(spark, values) == statistics.median(values)
    assert len(passes) <= 8


def test_moments_of_a_fit_vanish_and_those_of_a_wrong_model_do_not(spark):
    rnd = random.Random(4)
    rows = spark.createDataFrame(
        [(rnd.randint(1, 4), rnd.uniform(0, 9), str(rnd.randint(1, 5)), str(rnd.randint(1, 3)),
          rnd.choice(["1", "2", None]), rnd.uniform(1, 50), rnd.choice([0.0, 6.5]),
          rnd.uniform(0, 12)) for _ in range(600)],
        "passenger_count int, trip_distance double, PULocationID string, DOLocationID string, "
        "payment_type string, fare_amount double, tolls_amount double, tip_amount double")
    found = reg.prepared(rows)
    assert reg.prepared(rows.orderBy("fare_amount")) is found
    assert found.rows.count() == 600 and found.evaluation().count() + found.training().count() == 600
    scored = reg.predict(found.model, found.training())
    moments = reg.residual_moments(scored).collect()
    assert len(moments) == 2 + 4 + 5 + 3 + 3
    assert all(abs(r["moment"]) < 1e-9 for r in moments)
    wrong = scored.withColumn("predicted_tip_amount", F.col("predicted_tip_amount") * 1.1)
    assert sum(abs(r["moment"]) > 1e-3 for r in reg.residual_moments(wrong).collect()) > 10
