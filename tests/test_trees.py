"""Exported splits against the models they come from, here and in another engine."""

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from martlight.operators import scoring, trees
from martlight.session import materialize, shared_dir


@pytest.fixture(scope="module")
def rows(spark):
    drawn = spark.range(300).select(
        F.col("id").alias("user_id"),
        F.col("id").alias("vendor_id"),
        F.concat(F.lit("v"), "id").alias("vendor_name"),
        *[
            (F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 7).alias(c)
            for c in {*scoring.USER_FEATURES, *scoring.VENDOR_FEATURES}
        ],
    )
    risky = (F.col("monetary") + F.col("recency") > 130).cast("double")
    return materialize(
        drawn.withColumns({"label": risky, "performance_label": F.col("cost_price") * F.col("sales_volume")}), "test-trees"
    )


def elsewhere(rows, key, sql):
    """The expression's values in DuckDB."""
    scored = rows.toPandas()  # noqa: F841
    return dict(duckdb.sql(f"SELECT {key}, {sql} FROM scored").fetchall())


def test_forest_scores_the_same_as_sql(spark, rows):
    model = scoring.fit_user_risk(rows, trees=20).model
    splits = trees.export_splits(spark, model, scoring.USER_FEATURES, shared_dir(spark, "forest"))
    assert [(f.name, f.dataType.simpleString()) for f in splits.schema] == [
        tuple(c.split()) for c in trees.SPLITS_SCHEMA.split(", ")
    ]
    inputs = scoring.user_model_inputs(rows)
    ours = {r.user_id: r.score for r in trees.score_rows(inputs, splits).collect()}
    theirs = {r.user_id: r.risk_score for r in scoring.score_users(rows, model, "2025-07-01").collect()}
    assert ours == pytest.approx(theirs, abs=1e-6)
    assert elsewhere(inputs, "user_id", trees.score_sql(splits)) == pytest.approx(ours, abs=1e-12)
    assert len(set(ours.values())) > 20


def test_boosted_trees_score_the_same_as_sql(spark, rows):
    model = scoring.fit_vendor_performance(rows).model
    splits = trees.export_splits(spark, model, scoring.VENDOR_FEATURES, shared_dir(spark, "boosted"))
    inputs = scoring.vendor_model_inputs(rows)
    ours = {r.vendor_id: r.score for r in trees.score_rows(inputs, splits).collect()}
    theirs = {r.vendor_id: r.performance_score for r in scoring.score_vendors(rows, model, "2025-07-01").collect()}
    assert ours == pytest.approx(theirs, rel=1e-9)
    assert elsewhere(inputs, "vendor_id", trees.score_sql(splits)) == pytest.approx(ours, rel=1e-12)


def test_one_class_and_constant_input(spark, rows):
    """Training without class 1 scores 0; an input that never varies is scaled by 0."""
    flat = rows.withColumn("label", F.lit(0.0)).withColumn("recency", F.lit(5.0))
    stages = [
        VectorAssembler(inputCols=scoring.USER_FEATURES, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False),
        RandomForestClassifier(featuresCol="scaled_features", labelCol="label", numTrees=3, seed=1),
    ]
    model = Pipeline(stages=stages).fit(scoring.user_model_inputs(flat))
    splits = trees.export_splits(spark, model, scoring.USER_FEATURES, shared_dir(spark, "flat"))
    scored = trees.score_rows(scoring.user_model_inputs(flat), splits)
    assert [r.score for r in scored.select("score").distinct().collect()] == [0.0]


def test_missing_inputs_go_right_and_no_trees_score_zero(spark):
    splits = spark.createDataFrame(
        [(0, 0, "x", 2.0, 3.0, 1, 2, None, 1.0), (0, 1, None, None, None, None, None, 0.1, 1.0), (0, 2, None, None, None, None, None, 0.9, 1.0)],
        trees.SPLITS_SCHEMA,
    )
    values = [1.5, 1.6, None, float("nan"), float("inf"), float("-inf")]
    got = trees.score_rows(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double"), splits)
    assert [r.score for r in got.orderBy("i").collect()] == [0.1, 0.9, 0.9, 0.9, 0.9, 0.1]
    assert trees.score_rows(got.select("x"), splits.limit(0)).select("score").distinct().first().score == 0.0


def test_scoring_is_one_projection(spark, rows):
    model = scoring.fit_user_risk(rows, trees=100).model
    splits = trees.export_splits(spark, model, scoring.USER_FEATURES, shared_dir(spark, "wide"))
    plan = trees.score_rows(scoring.user_model_inputs(rows), splits)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
