"""Linear tip model: features, encoding, training, evaluation, prediction and explanation."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from tripmill.functions.exact import exact_avg
from tripmill.functions.keys import number_text
from tripmill.operators.selection import medians
from tripmill.session import workspace

# Feature columns, label and the text that stands for a null category.
NUMERIC = ["passenger_count", "trip_distance", "fare_amount", "tolls_amount"]
CATEGORICAL = ["PULocationID", "DOLocationID", "payment_type"]
LABEL = "tip_amount"
NULL_CATEGORY = "_null_filler"

# Search space of the tuning run.
L1_RANGE = (0.0, 20.0)
L2_CANDIDATES = (0.0, 0.1, 1.0, 10.0)


def features(trips: DataFrame) -> DataFrame:
    """Rows with a fare and a tip; ids become text so that they are read as categories."""
    kept = trips.where((F.col("fare_amount") != 0) & F.col(LABEL).isNotNull())
    return kept.select(
        "passenger_count", "trip_distance",
        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL],
        "fare_amount", "tolls_amount", LABEL)


def filled(rows: DataFrame) -> DataFrame:
    """Null categories replaced by their own value, numbers as double."""
    return rows.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(NULL_CATEGORY)) for c in CATEGORICAL},
        **{c: F.col(c).cast("double") for c in NUMERIC}})


def vocabulary(rows: DataFrame, column: str) -> DataFrame:
    """Categories of a column with their frequency, most frequent first, then alphabetical."""
    return (filled(rows).groupBy(F.col(column).alias("category"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category"))


def encoder() -> list:
    """Stages that turn filled rows into one feature vector.

    The last slot of each one-hot block is for categories not seen in training and is left out.
    """
    return [
        Imputer(inputCols=NUMERIC, outputCols=[f"{c}_num" for c in NUMERIC]),
        StringIndexer(inputCols=CATEGORICAL, outputCols=[f"{c}_idx" for c in CATEGORICAL],
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in CATEGORICAL],
                      outputCols=[f"{c}_vec" for c in CATEGORICAL]),
        VectorAssembler(inputCols=[f"{c}_num" for c in NUMERIC]
                        + [f"{c}_vec" for c in CATEGORICAL], outputCol="features"),
    ]


# Share of the rows held out for evaluation, at every size.
HELD_OUT = 0.2


def split(rows: DataFrame, held_out: float = HELD_OUT) -> DataFrame:
    """Add ``is_eval``, decided by a digest of the whole row.

    The same row always lands on the same side, on any cluster and after any task retry.
    """
    bound = f"{int(held_out * 16 ** 8):08x}"
    fields = [number_text(c) if kind == "double" else F.col(c).cast("string")
              for c, kind in rows.dtypes]
    text = F.concat_ws("|", *[F.coalesce(f, F.lit("")) for f in fields])
    return rows.withColumn("is_eval", F.substring(F.md5(text), 1, 8) < F.lit(bound))


def sides(rows: DataFrame, held_out: float = HELD_OUT) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows."""
    parts = split(rows, held_out)
    return parts.where(~F.col("is_eval")).drop("is_eval"), parts.where("is_eval").drop("is_eval")


def encode(rows: DataFrame) -> PipelineModel:
    """Encoder fitted on the rows, without the slot of the most frequent value of each category.

    With an intercept, a slot for every value would make the inputs depend on each other and leave
    their weights open. The value left out has weight 0, and the others are relative to it.
    """
    data = filled(rows)
    full = Pipeline(stages=encoder()).fit(data)
    indexer = next(s for s in full.stages if hasattr(s, "labelsArray"))
    kept, at = list(range(len(NUMERIC))), len(NUMERIC)
    for labels in indexer.labelsArray:
        kept += range(at + 1, at + len(labels))
        at += len(labels)
    assembler = full.stages[-1].copy({full.stages[-1].outputCol: "slots"})
    slicer = VectorSlicer(inputCol="slots", outputCol="features", indices=kept)
    return PipelineModel([*full.stages[:-1], assembler, slicer])


def train(rows: DataFrame, reg: float = 0.0, elastic: float = 0.0) -> PipelineModel:
    """Linear regression of the tip.

    The feature vector is short, so the normal equations are summed in one pass over the rows.
    """
    regression = LinearRegression(featuresCol="features", labelCol=LABEL, regParam=reg,
                                  elasticNetParam=elastic)
    encoding = encode(rows)
    return PipelineModel([*encoding.stages, regression.fit(encoding.transform(filled(rows)))])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Input columns plus ``predicted_tip_amount``."""
    scored = model.transform(filled(rows))
    return scored.select(*rows.columns, F.col("prediction").alias(f"predicted_{LABEL}"))


@dataclass(frozen=True)
class Prepared:
    """Feature rows with ``is_eval``, stored once, and the model of their training side."""

    rows: DataFrame
    model: PipelineModel

    def training(self) -> DataFrame:
        return self.rows.where(~F.col("is_eval")).drop("is_eval")

    def evaluation(self) -> DataFrame:
        return self.rows.where("is_eval").drop("is_eval")

    def every(self) -> DataFrame:
        return self.rows.drop("is_eval")


MOST_KEPT = 4
_prepared: dict[tuple[str, str], Prepared] = {}


def digest(rows: DataFrame) -> str:
    """A digest of all rows in any order, from one aggregate."""
    whole = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    other = F.xxhash64(F.lit(1), *rows.columns).cast("decimal(38,0)")
    return "-".join(map(str, rows.agg(F.count("*"), F.sum(whole), F.sum(other)).first()))


def prepared(rows: DataFrame) -> Prepared:
    """Rows dealt to their sides and stored, and the model, both kept by a digest of the rows.

    The digests that decide the sides are worked out once; all passes of the fit read the stored
    rows. The last few inputs of an application are kept.
    """
    spark = rows.sparkSession
    key = spark.sparkContext.applicationId, digest(rows)
    found = _prepared.get(key)
    if found is None:
        path = workspace(spark, "tip-rows")
        dealt = split(rows)
        dealt.write.partitionBy("is_eval").parquet(path)
        stored = spark.read.schema(dealt.schema).parquet(path)
        training = stored.where(~F.col("is_eval")).drop("is_eval")
        found = Prepared(stored, train(training))
        while len(_prepared) >= MOST_KEPT:
            del _prepared[next(iter(_prepared))]
        _prepared[key] = found
    return found


def evaluate(predictions: DataFrame) -> DataFrame:
    """Error metrics of predictions, from one aggregate."""
    label, guess = F.col(LABEL), F.col(f"predicted_{LABEL}")
    error = guess - label
    stats = predictions.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(F.pow(F.log1p(F.greatest(guess, F.lit(0.0))) - F.log1p(label), 2))
        .alias("mean_squared_log_error"),
        F.percentile_approx(F.abs(error), 0.5).alias("median_absolute_error"),
        F.var_pop(label).alias("_label_variance"), F.var_pop(error).alias("_error_variance"))
    return stats.select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error",
        "median_absolute_error",
        (1 - F.col("mean_squared_error") / F.nullif("_label_variance", F.lit(0.0)))
        .alias("r2_score"),
        (1 - F.col("_error_variance") / F.nullif("_label_variance", F.lit(0.0)))
        .alias("explained_variance"))


def evaluate_with(predictions: DataFrame, metric: str) -> float:
    """One metric (``mae``, ``mse``, ``rmse``, ``r2`` or ``var``) as a number."""
    return RegressionEvaluator(labelCol=LABEL, predictionCol=f"predicted_{LABEL}",
                               metricName=metric).evaluate(predictions)


def residual_moments(scored: DataFrame) -> DataFrame:
    """What a least-squares fit makes zero, from one aggregate over its training rows.

    ``input``, ``category``, ``n`` and ``moment``: the sum of value times residual over the root of
    both sums of squares, for the intercept, each numeric input, each category value (as a value of
    1) and the prediction itself. Rows need the inputs, the label and the prediction.
    """
    guess, label = F.col(f"predicted_{LABEL}"), F.col(LABEL)
    rows = filled(scored).withColumn("residual", label - guess)
    values = [F.struct(F.lit(name).alias("input"), F.lit(None).cast("string").alias("category"),
                       value.alias("x"))
              for name, value in [("intercept", F.lit(1.0)), ("prediction", guess),
                                  *[(c, F.col(c)) for c in NUMERIC]]]
    values += [F.struct(F.lit(c).alias("input"), F.col(c).alias("category"),
                        F.lit(1.0).alias("x")) for c in CATEGORICAL]
    stacked = rows.select("residual", F.inline(F.array(*values)))
    sums = stacked.groupBy("input", "category").agg(
        F.count("x").alias("n"), F.sum(F.col("x") * F.col("residual")).alias("xr"),
        F.sum(F.col("x") * F.col("x")).alias("xx"),
        F.sum(F.col("residual") * F.col("residual")).alias("rr"))
    size = F.sqrt(F.col("xx") * F.col("rr"))
    return sums.select("input", "category", "n",
                       F.coalesce(F.col("xr") / F.nullif(size, F.lit(0.0)), F.lit(0.0))
                       .alias("moment"))


def feature_info(rows: DataFrame) -> DataFrame:
    """Per input: min, max, mean, median, deviation, number of categories and of nulls.

    All inputs share one pass, and their medians the few passes of a selection.
    """
    aggregates, structs = [], []
    middle = medians(rows, NUMERIC)
    for i, name in enumerate(NUMERIC):
        col = F.col(name).cast("double")
        aggregates += [
            F.min(col).alias(f"min{i}"), F.max(col).alias(f"max{i}"),
            exact_avg(col).alias(f"mean{i}"),
            F.stddev_samp(col).alias(f"stddev{i}"), F.count_if(col.isNull()).alias(f"null{i}")]
        structs.append(F.struct(
            F.lit(name).alias("input"), F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"), F.col(f"mean{i}").alias("mean"),
            F.lit(middle[name]).cast("double").alias("median"),
            F.col(f"stddev{i}").alias("stddev"),
            F.lit(None).cast("bigint").alias("category_count"),
            F.col(f"null{i}").alias("null_count")))
    numeric = rows.agg(*aggregates).select(F.inline(F.array(*structs)))
    nothing = F.lit(None).cast("double")
    # One pass for all categories: their values stacked, counted, then summed up by input.
    values = rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("input"), F.col(c).cast("string").alias("value"))
        for c in CATEGORICAL])))
    counts = values.groupBy("input", "value").agg(F.count(F.lit(1)).alias("n"))
    categories = counts.groupBy("input").agg(
        F.count("value").alias("category_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        .alias("null_count")).select(
            "input", *[nothing.alias(s) for s in ("min", "max", "mean", "median", "stddev")],
            "category_count", "null_count")
    return numeric.unionByName(categories)


def slots(rows: DataFrame) -> DataFrame:
    """``feature``, ``category`` and ``slot`` of the fitted one-hot blocks, from their labels."""
    indexer = next(s for s in Pipeline(stages=encoder()[:2]).fit(filled(rows)).stages
                   if hasattr(s, "labelsArray"))
    listed = [(c, label, i) for c, labels in zip(CATEGORICAL, indexer.labelsArray)
              for i, label in enumerate(labels)]
    return rows.sparkSession.createDataFrame(listed, "feature string, category string, slot int")


@dataclass(frozen=True)
class Baseline:
    """What a prediction is measured against: mean of each input and mean category weight."""

    numeric: dict[str, float]
    categorical: dict[str, float]
    prediction: float


def _weights(model: PipelineModel) -> tuple[dict[str, float], dict[str, list[float]], float]:
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    regression = model.stages[-1]
    coefficients = [float(v) for v in regression.coefficients]
    numeric = dict(zip(NUMERIC, coefficients))
    blocks, at = {}, len(NUMERIC)
    for column, labels in zip(CATEGORICAL, indexer.labelsArray):
        blocks[column] = [0.0] + coefficients[at:at + len(labels) - 1] + [0.0]
        at += len(labels) - 1
    return numeric, blocks, float(regression.intercept)


def baseline(model: PipelineModel, rows: DataFrame) -> Baseline:
    """Means over a set of rows, from one pass."""
    numeric, blocks, intercept = _weights(model)
    encoded = _indexed(model, rows)
    weight = {c: F.get(F.lit(w), F.col(f"{c}_idx").cast("int")) for c, w in blocks.items()}
    row = encoded.agg(*[F.avg(f"{c}_num").alias(c) for c in NUMERIC],
                      *[F.avg(w).alias(c) for c, w in weight.items()]).first()
    means = {c: row[c] or 0.0 for c in NUMERIC}
    block_means = {c: row[c] or 0.0 for c in CATEGORICAL}
    total = intercept + sum(numeric[c] * means[c] for c in NUMERIC) + sum(block_means.values())
    return Baseline(means, block_means, total)


def _indexed(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows after imputing and indexing, without building vectors."""
    out = filled(rows)
    for stage in model.stages[:2]:
        out = stage.transform(out)
    return out


def explain(model: PipelineModel, rows: DataFrame, base: Baseline, k: int = 3) -> DataFrame:
    """Predictions with the ``k`` inputs that move them furthest from the baseline.

    The contribution of an input is its weight times the distance from the mean. All of it is
    column arithmetic over a literal weight array, so no vector is built and no Python runs.
    """
    numeric, blocks, intercept = _weights(model)
    encoded = _indexed(model, rows)
    parts = {c: F.lit(numeric[c]) * (F.col(f"{c}_num") - F.lit(base.numeric[c]))
             for c in NUMERIC}
    parts |= {c: F.get(F.lit(w), F.col(f"{c}_idx").cast("int")) - F.lit(base.categorical[c])
              for c, w in blocks.items()}
    attributions = F.array(*[
        F.struct((-F.abs(v)).alias("order"), F.lit(c).alias("feature"), v.alias("attribution"))
        for c, v in parts.items()])
    total = reduce(lambda a, b: a + b, parts.values())
    top = F.slice(F.array_sort(attributions), 1, k)
    return encoded.select(
        *[F.col(c) for c in rows.columns],
        (F.lit(base.prediction) + total).alias(f"predicted_{LABEL}"),
        F.transform(top, lambda x: F.struct(x["feature"].alias("feature"),
                                            x["attribution"].alias("attribution")))
        .alias("top_feature_attributions"),
        F.lit(base.prediction).alias("baseline_prediction"))


def trials(n: int = 5, seed: int = 42) -> list[tuple[float, float]]:
    """Sampled ``(l1, l2)`` pairs, the first without any penalty."""
    rng = random.Random(seed)
    return [(0.0, 0.0)] + [(round(rng.uniform(*L1_RANGE), 4), rng.choice(L2_CANDIDATES))
                           for _ in range(n - 1)]


@dataclass(frozen=True)
class Tuning:
    """Evaluation error of each tried pair of penalties, and the model with the least."""

    trials: list[tuple[float, float]]
    errors: list[float]
    best: PipelineModel


def tune(rows: DataFrame, n: int = 5, parallel: int = 2, seed: int = 42,
         grid: Sequence[tuple[float, float]] | None = None,
         held_out: float = HELD_OUT, dealt: Prepared | None = None) -> Tuning:
    """Try ``n`` penalties, ``parallel`` at a time, and keep the model with the least error.

    The digest split decides the sides. Categories and missing numbers are learned from the training
    side alone, and its rows are encoded once. With ``dealt``, the prepared rows of ``rows``, their
    stored sides and the encoding of their model are used instead of dealing and encoding again.
    """
    tried = list(grid or trials(n, seed))
    if dealt is None:
        training, evaluation = sides(rows, held_out)
        encoding = encode(training)
    else:
        training, evaluation = dealt.training(), dealt.evaluation()
        encoding = PipelineModel(dealt.model.stages[:-1])
    encoded = [encoding.transform(filled(side)).select("features", LABEL).persist()
               for side in (training, evaluation)]
    scorer = RegressionEvaluator(labelCol=LABEL, metricName="mse")

    def attempt(pair: tuple[float, float]):
        total = sum(pair)
        model = LinearRegression(featuresCol="features", labelCol=LABEL, regParam=total,
                                 elasticNetParam=pair[0] / total if total else 0.0).fit(encoded[0])
        return scorer.evaluate(model.transform(encoded[1])), model

    try:
        with ThreadPool(parallel) as pool:
            found = pool.map(attempt, tried)
    finally:
        for side in encoded:
            side.unpersist()
    errors = [float(e) for e, _ in found]
    best = found[errors.index(min(errors))][1]
    return Tuning(tried, errors, PipelineModel([*encoding.stages, best]))
