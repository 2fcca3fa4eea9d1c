"""Training, evaluation and scoring of the user-risk and vendor-performance models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.functions.columns import DateLike, as_date, class_probability, half_up, ratio
from martlight.session import materialize

# Model inputs, in vector order, and seed.
USER_FEATURES = [
    "frequency",
    "monetary",
    "recency",
    "avg_discount",
    "return_rate_model",
    "user_tenure",
    "prepaid_card_count",
]
USER_FEATURES_V1 = [*USER_FEATURES[:-1], "vip_level"]
VENDOR_FEATURES = [
    "cost_price",
    "service_quality",
    "avg_delivery_time",
    "avg_profit_margin",
    "sales_volume",
    "sales_value",
    "order_return_rate",
]
SEED = 42

# Training rows of one task.
ROWS_PER_TASK = 50_000

# Largest first byte of a key's digest, as hex, that goes to training: 205 of 256.
_LAST_TRAINING_BYTE = "cc"


def split_by_key(df: DataFrame, key: str) -> DataFrame:
    """Add ``is_train``: a fixed 80 % of the keys, whatever the partitioning or run."""
    first_byte = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 2)
    return df.withColumn("is_train", F.when(first_byte <= _LAST_TRAINING_BYTE, 1).otherwise(0))


def train_test_split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The training and the held-out rows."""
    marked = split_by_key(df, key)
    return (
        marked.where(F.col("is_train") == 1).drop("is_train"),
        marked.where(F.col("is_train") == 0).drop("is_train"),
    )


@dataclass(frozen=True)
class Evaluated:
    """A fitted pipeline and its metric on the held-out rows."""

    model: PipelineModel
    metric_name: str
    metric: float
    train_rows: int
    test_rows: int


def _spread(train: DataFrame, key: str, rows: int, rows_per_task: int) -> DataFrame:
    """Training rows over as many tasks as their number asks for, in a fixed place and order.

    Trees draw their samples per partition: hashing and sorting by the key, over tasks counted from
    the rows alone, makes the model the same on any cluster and whatever files the rows came from.
    """
    return train.repartition(max(1, -(-rows // rows_per_task)), key).sortWithinPartitions(key)


def _fit(
    features: DataFrame, key: str, pipeline: Pipeline, evaluator: Evaluator, rows_per_task: int = ROWS_PER_TASK
) -> Evaluated:
    marked = split_by_key(features, key)
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("is_train"), F.lit(0)).alias("train")).first()
    train, test = train_test_split(features, key)
    train = _spread(train, key, counts["train"], rows_per_task).cache()
    try:
        model = pipeline.fit(train)
        metric = evaluator.evaluate(model.transform(test))
    finally:
        train.unpersist()
    name = evaluator.getOrDefault(evaluator.metricName)
    return Evaluated(model, name, metric, counts["train"], counts["n"] - counts["train"])


def holdout_auc(scored: DataFrame, key: str, score: str, label: str) -> DataFrame:
    """One row: area under ROC of a numeric score on the held-out rows, six decimals, and their number."""
    test = train_test_split(scored, key)[1].select(F.col(score).cast("double"), F.col(label).cast("double"))
    # numBins 0: every distinct score is a step of the curve.
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, numBins=0)
    return _metric(test, evaluator.evaluate(test))


def rank_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: the exact area under ROC of a numeric score, six decimals, and the number of rows.

    The chance that a positive scores above a negative, equal scores counting one half. Rows are counted
    per distinct score first; scores are then parted by ranges, a range starts from the negatives of the
    ranges below it, and ranks run within ranges, so no task holds all scores. Counts are whole
    numbers: the result depends on no order. Rows with a null or NaN score or a null label don't
    count; without a positive or a negative the area is null.
    """
    value, positive = F.col(score).cast("double"), F.col(label).cast("double") == 1
    rows = scored.select(value.alias("score"), positive.alias("positive")).where("score is not null and not isnan(score)")
    counts = rows.groupBy("score").agg(F.count_if("positive").alias("good"), F.count_if(~F.col("positive")).alias("bad"))
    ranges = counts.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    ranges = materialize(ranges, "score-ranges")
    # As many rows as there are ranges.
    below = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("part").agg(F.min("score").alias("least"), F.sum("bad").alias("own"))
    parts = parts.select("part", F.coalesce(F.sum("own").over(below), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("before") + F.coalesce(F.sum("bad").over(inside), F.lit(0))
    twice = (F.col("good") * (2 * lower + F.col("bad"))).cast("decimal(38,0)")
    ranked = ranges.join(F.broadcast(parts), "part").select("good", "bad", twice.alias("twice"))
    total = ranked.agg(F.sum("twice").alias("twice"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    pairs = 2 * F.col("good").cast("double") * F.col("bad")
    return total.select(
        half_up(ratio(F.col("twice"), pairs), 6).alias("value"),
        F.coalesce(F.col("good") + F.col("bad"), F.lit(0)).cast("long").alias("test_rows"),
    )


def holdout_rmse(scored: DataFrame, key: str, score: str, label: str) -> DataFrame:
    """One row: root mean squared error of a numeric prediction on the held-out rows, six decimals."""
    test = train_test_split(scored, key)[1].select(F.col(score).cast("double"), F.col(label).cast("double"))
    return _metric(test, RegressionEvaluator(predictionCol=score, labelCol=label).evaluate(test))


def _metric(rows: DataFrame, value: float) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("test_rows")).select(
        half_up(F.lit(value), 6).alias("value"), "test_rows"
    )


def user_model_inputs(features: DataFrame, inputs: list[str] = USER_FEATURES) -> DataFrame:
    """Feature rows the assembler accepts: an unknown tenure counts as 0 days."""
    return features.na.fill(0, subset=["user_tenure"]).select(
        "user_id", "label", *[F.col(c).cast("double").alias(c) for c in inputs]
    )


def _scaling(inputs: list[str]) -> list:
    """Assemble the inputs and divide each by its standard deviation, without centring."""
    return [
        VectorAssembler(inputCols=inputs, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False),
    ]


def scale_user_features(features: DataFrame, inputs: list[str] = USER_FEATURES) -> DataFrame:
    """What the user model sees: every row's inputs, scaled by the training rows, six decimals."""
    rows = user_model_inputs(features, inputs)
    train, _ = train_test_split(rows, "user_id")
    scaled = vector_to_array("scaled_features")
    return (
        Pipeline(stages=_scaling(inputs))
        .fit(train)
        .transform(rows)
        .select("user_id", *[half_up(scaled[i], 6).alias(f"{c}_scaled") for i, c in enumerate(inputs)])
    )


def fit_user_risk(
    features: DataFrame, inputs: list[str] = USER_FEATURES, trees: int = 100, rows_per_task: int = ROWS_PER_TASK
) -> Evaluated:
    """Random forest on the scaled features; metric is the area under ROC."""
    forest = RandomForestClassifier(
        featuresCol="scaled_features", labelCol="label", numTrees=trees, seed=SEED
    )
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    return _fit(
        user_model_inputs(features, inputs),
        "user_id",
        Pipeline(stages=[*_scaling(inputs), forest]),
        evaluator,
        rows_per_task,
    )


def score_users(
    features: DataFrame, model: PipelineModel, as_of: DateLike, inputs: list[str] = USER_FEATURES
) -> DataFrame:
    """user_id, is_high_risk, risk_score, scoring_date of every row in ``features``."""
    return model.transform(user_model_inputs(features, inputs)).select(
        "user_id",
        F.col("prediction").alias("is_high_risk"),
        class_probability("probability", 1).alias("risk_score"),
        as_date(as_of).alias("scoring_date"),
    )


def score_users_by_rule(labelled: DataFrame, as_of: DateLike) -> DataFrame:
    """The same score table straight from the rule label, with no model."""
    return labelled.select(
        "user_id",
        F.col("label").alias("is_high_risk"),
        F.col("label").cast("float").alias("risk_score"),
        as_date(as_of).alias("scoring_date"),
    )


def vendor_model_inputs(features: DataFrame, inputs: list[str] = VENDOR_FEATURES) -> DataFrame:
    return features.select(
        "vendor_id", "vendor_name", "performance_label", *[F.col(c).cast("double").alias(c) for c in inputs]
    )


def fit_vendor_performance(
    features: DataFrame, rounds: int = 10, rows_per_task: int = ROWS_PER_TASK
) -> Evaluated:
    """Gradient-boosted trees on the scaled features; metric is the RMSE."""
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=VENDOR_FEATURES, outputCol="unscaled_features"),
            StandardScaler(inputCol="unscaled_features", outputCol="features"),
            GBTRegressor(featuresCol="features", labelCol="performance_label", maxIter=rounds, seed=SEED),
        ]
    )
    evaluator = RegressionEvaluator(labelCol="performance_label", metricName="rmse")
    return _fit(vendor_model_inputs(features), "vendor_id", pipeline, evaluator, rows_per_task)


def score_vendors(features: DataFrame, model: PipelineModel, as_of: DateLike) -> DataFrame:
    """vendor_id, vendor_name, performance_score, scoring_date of every row in ``features``."""
    return model.transform(vendor_model_inputs(features)).select(
        "vendor_id",
        "vendor_name",
        F.col("prediction").alias("performance_score"),
        as_date(as_of).alias("scoring_date"),
    )


def score_vendors_by_rule(labelled: DataFrame, as_of: DateLike) -> DataFrame:
    """The same score table straight from the performance label, with no model."""
    return labelled.select(
        "vendor_id",
        "vendor_name",
        F.col("performance_label").alias("performance_score"),
        as_date(as_of).alias("scoring_date"),
    )
