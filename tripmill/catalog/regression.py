"""Tip model, fitted once on the training side and used by all queries on it.

A least-squares fit with intercept meets these statements on the rows it was fitted on: for every
category value the mean prediction is the mean label, the mean error is 0, and the error is
uncorrelated with each numeric input. They are what SQL can say of the model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill.catalog.prelude import mean, number_text
from tripmill.catalog.registry import query
from tripmill.operators import regression as reg
from tripmill.sources import adapters

_FEATURES = """
, features AS (
  SELECT passenger_count, trip_distance, CAST(PULocationID AS VARCHAR) AS PULocationID,
    CAST(DOLocationID AS VARCHAR) AS DOLocationID, CAST(payment_type AS VARCHAR) AS payment_type,
    fare_amount, tolls_amount, tip_amount
  FROM yellow WHERE fare_amount <> 0 AND tip_amount IS NOT NULL
)"""


def _rows(spark, d):
    return reg.features(adapters.yellow(spark, d))


@query("ml_features", _FEATURES + " SELECT * FROM features")
def ml_features(spark, d):
    return _rows(spark, d)


@query("ml_encode", _FEATURES + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, category,
  CAST(row_number() OVER (ORDER BY n DESC, category) - 1 AS INTEGER) AS slot FROM (
    SELECT coalesce({c}, '_null_filler') AS category, count(*) AS n FROM features GROUP BY 1)
""" for c in reg.CATEGORICAL))
def ml_encode(spark, d):
    """Slot of every category in the fitted one-hot vectors."""
    return reg.slots(_rows(spark, d))


_DIGESTS = f"""
, digests AS (
  SELECT *, substr(md5(concat_ws('|', CAST(passenger_count AS VARCHAR),
    {number_text('trip_distance')}, PULocationID, DOLocationID, coalesce(payment_type, ''),
    {number_text('fare_amount')}, {number_text('tolls_amount')}, {number_text('tip_amount')})),
    1, 8) < '33333333' AS is_eval FROM features
)"""


@query("ml_split", _FEATURES + _DIGESTS + " SELECT is_eval, count(*) AS n FROM digests GROUP BY 1")
def ml_split(spark, d):
    return reg.split(_rows(spark, d)).groupBy("is_eval").agg(F.count(F.lit(1)).alias("n"))


def _prepared(spark, d):
    return reg.prepared(_rows(spark, d))


@query("ml_train", _FEATURES + _DIGESTS + """
, training AS (SELECT * FROM digests WHERE NOT is_eval)
""" + " UNION ALL ".join([f"""
SELECT '{name}' AS input, CAST(NULL AS VARCHAR) AS category, count({of}) AS n,
  CAST(0 AS DOUBLE) AS moment FROM training
""" for name, of in [("intercept", "*"), ("prediction", "*"), *[(c, c) for c in reg.NUMERIC]]] + [f"""
SELECT '{c}', coalesce({c}, '_null_filler'), count(*), CAST(0 AS DOUBLE) FROM training GROUP BY ALL
""" for c in reg.CATEGORICAL]))
def ml_train(spark, d):
    """All moments that a least-squares fit makes zero on its training rows."""
    found = _prepared(spark, d)
    moments = reg.residual_moments(reg.predict(found.model, found.training()))
    return moments.withColumn("moment", F.round("moment", 6) + 0.0)


_INFO = """SELECT '{c}' AS input, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  {mean} AS mean, CAST(median({c}) AS DOUBLE) AS median, round(stddev_samp({c}), 6) AS stddev,
  CAST(NULL AS BIGINT) AS category_count,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM features"""
_INFO_CATEGORY = """SELECT '{c}', NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
  count(*) FILTER (WHERE {c} IS NULL) FROM features"""


@query("ml_feature_info", _FEATURES + " UNION ALL ".join(
    [_INFO.format(c=c, mean=mean(c)) for c in reg.NUMERIC]
    + [_INFO_CATEGORY.format(c=c) for c in reg.CATEGORICAL]))
def ml_feature_info(spark, d):
    return reg.feature_info(_rows(spark, d)).withColumn("stddev", F.round("stddev", 6))


@query("ml_evaluate", _FEATURES + _DIGESTS + """
SELECT is_eval, count(*) AS n, round(avg(tip_amount), 4) + 0.0 AS mean_label,
  CASE WHEN NOT is_eval THEN round(avg(tip_amount), 4) + 0.0 END AS mean_prediction,
  CASE WHEN NOT is_eval THEN round(var_pop(tip_amount), 4) + 0.0 END AS explained_and_error,
  CASE WHEN NOT is_eval THEN CAST(0 AS DOUBLE) END AS r2_less_explained,
  true AS metrics_in_range FROM digests GROUP BY is_eval""")
def ml_evaluate(spark, d):
    """Metrics of both sides against what holds of a least-squares fit on its training side.

    There the mean prediction is the mean label, the variance of the predictions and the mean
    squared error add up to the variance of the labels, and both kinds of explained share agree. On
    the other side errors are in range: no metric is missing, and the model beats the mean.
    """
    found = _prepared(spark, d)
    sides = []
    for is_eval, rows in ((False, found.training()), (True, found.evaluation())):
        scored = reg.predict(found.model, rows)
        guess = F.col("predicted_tip_amount")
        sums = scored.agg(F.count("*").alias("n"), F.avg("tip_amount").alias("label"),
                          F.avg(guess).alias("guess"), F.var_pop(guess).alias("spread"))
        both = sums.join(reg.evaluate(scored))  # one row each

        def fitted(value, is_eval=is_eval):
            shown = F.round(value, 4) + 0.0
            return F.lit(None).cast("double") if is_eval else shown
        sides.append(both.select(
            F.lit(is_eval).alias("is_eval"), "n", (F.round("label", 4) + 0.0).alias("mean_label"),
            fitted(F.col("guess")).alias("mean_prediction"),
            fitted(F.col("spread") + F.col("mean_squared_error")).alias("explained_and_error"),
            fitted(F.col("r2_score") - F.col("explained_variance")).alias("r2_less_explained"),
            ((F.col("mean_absolute_error") >= 0) & (F.col("median_absolute_error") >= 0)
             & (F.col("mean_squared_log_error") >= 0) & (F.col("r2_score") <= 1)
             & (F.pow("mean_absolute_error", F.lit(2)) <= F.col("mean_squared_error") + 1e-9))
            .alias("metrics_in_range")).where("n > 0"))
    return sides[0].unionByName(sides[1])


@query("ml_predict", _FEATURES + _DIGESTS + """
SELECT is_eval, PULocationID, count(*) AS n, count(*) AS n_predicted,
  CASE WHEN NOT is_eval THEN round(avg(tip_amount), 4) + 0.0 END AS mean_prediction
FROM digests GROUP BY is_eval, PULocationID""")
def ml_predict(spark, d):
    """Rows and predictions by pickup zone and side; on the training side also their mean.

    The zone is an input, so on the training side its mean prediction is its mean tip.
    """
    found = _prepared(spark, d)
    scored = reg.predict(found.model, found.rows)
    return scored.groupBy("is_eval", "PULocationID").agg(
        F.count("*").alias("n"), F.count("predicted_tip_amount").alias("n_predicted"),
        F.when(~F.first("is_eval"), F.round(F.avg("predicted_tip_amount"), 4) + 0.0)
        .alias("mean_prediction"))


@query("ml_explain", _FEATURES + """
SELECT count(*) AS n, count(*) AS n_as_predicted, count(*) AS n_as_weighted,
  CAST(0 AS DOUBLE) AS mean_attribution FROM features""")
def ml_explain(spark, d):
    """Rows; rows whose baseline and attributions add up to what the model itself predicts; rows
    whose numeric attributions are the model's weights times the distance from the mean; and the
    mean attribution, which is 0 by the choice of the baseline."""
    found = _prepared(spark, d)
    rows, model = found.every(), found.model
    base = reg.baseline(model, rows)
    scored = reg.predict(model, rows).withColumnRenamed("predicted_tip_amount", "own")
    explained = reg.explain(model, scored, base, len(reg.NUMERIC + reg.CATEGORICAL))
    parts = F.col("top_feature_attributions")
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x["attribution"])
    as_weighted = F.lit(True)
    filler = dict(zip(reg.NUMERIC, model.stages[0].surrogateDF.first()))

    def attribution(name):
        return F.filter(parts, lambda x: x["feature"] == name)[0]["attribution"]
    for c, weight in zip(reg.NUMERIC, model.stages[-1].coefficients):
        given = attribution(c)
        value = F.coalesce(F.col(c).cast("double"), F.lit(filler[c]))
        as_weighted &= F.abs(given - float(weight) * (value - base.numeric[c])) < 1e-6
    off = F.col("baseline_prediction") + total - F.col("own")
    return explained.agg(F.count(F.lit(1)).alias("n"),
                         F.count_if(F.abs(off) < 1e-6).alias("n_as_predicted"),
                         F.count_if(as_weighted).alias("n_as_weighted"),
                         (F.round(F.avg(total), 4) + 0.0).alias("mean_attribution"))


# A penalty under which every weight is 0 and the prediction is the mean training tip.
_OVERWHELMING = (1e6, 0.0)


@query("ml_tune", _FEATURES + _DIGESTS + """
, seen AS (SELECT avg(tip_amount) AS tip FROM digests WHERE NOT is_eval)
SELECT count(*) FILTER (NOT is_eval) AS n_training, count(*) FILTER (is_eval) AS n_evaluation,
  CAST(6 AS BIGINT) AS n_trials,
  round(avg((tip_amount - tip) * (tip_amount - tip)) FILTER (is_eval), 4) + 0.0 AS error_of_mean,
  true AS best_beats_mean, true AS best_has_least_error
FROM digests, seen""")
def ml_tune(spark, d):
    """Rows of each side and trials; the error of the trial that leaves only the mean, which SQL can
    tell; and whether the model kept has the least error of all when it is scored again."""
    found = _prepared(spark, d)
    tuned = reg.tune(found.every(), grid=[*reg.trials(), _OVERWHELMING], dealt=found)
    again = reg.evaluate_with(reg.predict(tuned.best, found.evaluation()), "mse")
    return found.rows.agg(
        F.count_if(~F.col("is_eval")).alias("n_training"),
        F.count_if("is_eval").alias("n_evaluation"),
        F.lit(len(tuned.trials)).cast("bigint").alias("n_trials"),
        (F.round(F.lit(tuned.errors[-1]), 4) + 0.0).alias("error_of_mean"),
        F.lit(again <= tuned.errors[-1] + 1e-9).alias("best_beats_mean"),
        F.lit(abs(again - min(tuned.errors)) <= 1e-9 * again).alias("best_has_least_error"))
