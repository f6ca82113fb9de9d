from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripmill.operators import regression as reg
from tripmill.sources import adapters


@pytest.fixture(scope="module")
def exact(spark):
    """Tips that follow a linear rule of distance, tolls and payment type exactly."""
    df = spark.range(2000).select(
        (F.col("id") % 5).cast("int").alias("passenger_count"),
        (F.col("id") % 37 + 0.5).alias("trip_distance"),
        (F.col("id") % 7).cast("int").alias("PULocationID"),
        (F.col("id") % 11).cast("int").alias("DOLocationID"),
        F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 3).cast("int"))
        .alias("payment_type"),
        (F.col("id") % 53 + 1.0).alias("fare_amount"),
        (F.col("id") % 2 * 6.5).alias("tolls_amount"))
    tip = (1.0 + 0.5 * F.col("trip_distance") + 0.1 * F.col("tolls_amount")
           + F.coalesce(F.col("payment_type") * 2.0, F.lit(7.0)))
    return reg.features(df.withColumn("tip_amount", tip)).cache()


@pytest.fixture(scope="module")
def model(exact):
    return reg.train(exact)


def test_features_drop_zero_fares_and_missing_tips(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1, 1, 1, 0.0, 0.0, 1.0), (1, 1.0, 1, 1, None, 5.0, 0.0, None),
         (1, 1.0, 1, 1, None, 5.0, 0.0, 2.0)],
        "passenger_count int, trip_distance double, PULocationID int, DOLocationID int, "
        "payment_type int, fare_amount double, tolls_amount double, tip_amount double")
    got = reg.features(df)
    assert got.count() == 1 and dict(got.dtypes)["PULocationID"] == "string"


def test_exact_rule_is_recovered(exact, model):
    weights = dict(zip(reg.NUMERIC, model.stages[-1].coefficients))
    assert weights["trip_distance"] == pytest.approx(0.5, abs=1e-5)
    assert weights["tolls_amount"] == pytest.approx(0.1, abs=1e-5)
    assert weights["fare_amount"] == pytest.approx(0.0, abs=1e-5)
    scored = reg.predict(model, exact)
    assert scored.count() == exact.count()
    metrics = reg.evaluate(scored).first()
    assert metrics.mean_absolute_error < 1e-4 and metrics.r2_score > 0.999999


def test_metrics_agree_with_the_library(spark, sf):
    rows = reg.features(adapters.yellow(spark, sf))
    scored = reg.predict(reg.train(rows), rows).cache()
    metrics = reg.evaluate(scored).first()
    for name, metric in (("mean_absolute_error", "mae"), ("mean_squared_error", "mse"),
                         ("r2_score", "r2")):
        assert metrics[name] == pytest.approx(reg.evaluate_with(scored, metric), rel=1e-9)


def test_explanations_add_up_and_rank(exact, model):
    base = reg.baseline(model, exact)
    everything = reg.explain(model, exact, base, k=7).limit(50).collect()
    scored = {tuple(r[c] for c in exact.columns): r[-1]
              for r in reg.predict(model, exact).collect()}
    for row in everything:
        parts = [a.attribution for a in row.top_feature_attributions]
        assert base.prediction + sum(parts) == pytest.approx(row.predicted_tip_amount, abs=1e-6)
        assert row.predicted_tip_amount == pytest.approx(
            scored[tuple(row[c] for c in exact.columns)], abs=1e-6)
        assert [abs(p) for p in parts] == sorted(map(abs, parts), reverse=True)
    assert len(reg.explain(model, exact, base).first().top_feature_attributions) == 3


def test_explanations_stay_in_the_engine(exact, model):
    assert "Python" not in plan_of(reg.explain(model, exact, reg.baseline(model, exact)))


def test_unseen_category_scores(spark, exact, model):
    odd = exact.limit(1).withColumn("PULocationID", F.lit("999"))
    assert reg.predict(model, odd).first().predicted_tip_amount is not None


def test_missing_number_is_imputed(exact, model):
    gap = exact.limit(1).withColumn("trip_distance", F.lit(None).cast("double"))
    assert reg.predict(model, gap).first().predicted_tip_amount is not None


def test_split_is_repeatable_and_sized(exact):
    once, again = reg.split(exact, 0.2), reg.split(exact.repartition(3), 0.2)
    assert once.exceptAll(again).count() == 0
    share = once.where("is_eval").count() / once.count()
    assert 0.15 < share < 0.25
    assert reg.split(exact, 0.0).where("is_eval").count() == 0


def test_sides_are_a_fifth_at_every_size(exact):
    for n in (200, 2000):
        training, evaluation = reg.sides(exact.limit(n))
        assert training.count() + evaluation.count() == n
        assert 0.1 < evaluation.count() / n < 0.3


def test_training_side_means_are_met(exact):
    training, _ = reg.sides(exact)
    scored = reg.filled(reg.predict(reg.train(training), training))
    for c in reg.CATEGORICAL:
        for r in scored.groupBy(c).agg(F.avg("predicted_tip_amount").alias("a"),
                                       F.avg(reg.LABEL).alias("b")).collect():
            assert r.a == pytest.approx(r.b, abs=1e-9)


def test_weights_are_relative_to_the_most_frequent_category(exact, model):
    weights = reg._weights(model)[1]
    assert all(w[0] == 0.0 and w[-1] == 0.0 for w in weights.values())
    labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray[2]
    by = dict(zip(labels, weights["payment_type"]))
    assert by["2"] - by["1"] == pytest.approx(2.0, abs=1e-6)
    assert by[reg.NULL_CATEGORY] - by["1"] == pytest.approx(5.0, abs=1e-6)


def test_vocabulary_counts_nulls_as_a_category(exact):
    got = {r.category: r.n for r in reg.vocabulary(exact, "payment_type").collect()}
    assert set(got) == {"1", "2", reg.NULL_CATEGORY} and sum(got.values()) == exact.count()


def test_feature_info_median(exact):
    got = {r.input: r for r in reg.feature_info(exact).collect()}
    distances = sorted(r[0] for r in exact.select("trip_distance").collect())
    assert got["trip_distance"].median == pytest.approx(distances[len(distances) // 2], abs=1)
    assert got["payment_type"].category_count == 2
    assert got["payment_type"].null_count == exact.where("payment_type is null").count()
    assert got["fare_amount"].min == 1.0 and got["fare_amount"].max == 53.0


def test_tuning_tries_every_penalty(exact):
    found = reg.tune(exact)
    assert len(found.errors) == len(found.trials) == 5
    assert min(range(5), key=found.errors.__getitem__) == 0
    assert all(0 <= l1 <= 20 and l2 in reg.L2_CANDIDATES for l1, l2 in reg.trials())


def test_tuning_on_prepared_rows_reuses_their_sides_and_encoding(exact):
    """Round 3, F1: the stored sides and the model's encoding are used, with the same errors."""
    found = reg.prepared(exact)
    again = reg.tune(found.every(), dealt=found)
    fresh = reg.tune(exact)
    assert again.errors == pytest.approx(fresh.errors, rel=1e-9, abs=1e-12)
    assert "md5" not in plan_of(found.evaluation()).lower()
    assert again.best.stages[:-1] == found.model.stages[:-1]
