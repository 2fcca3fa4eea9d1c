"""Tree ensembles as rows of splits, and as SQL text that scores rows without the library that fitted them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SPLITS_SCHEMA = (
    "tree int, node int, feature string, scale double, threshold double, left int, right int, leaf double, weight double"
)


def export_splits(spark: SparkSession, model: PipelineModel, inputs: Sequence[str], path: str) -> DataFrame:
    """Rows (SPLITS_SCHEMA) of a fitted pipeline: an assembler of ``inputs``, a scaler without centring, trees.

    A split sends a row left if ``feature`` times ``scale`` is at most ``threshold``. ``leaf`` is a
    leaf's prediction, of a classifier its share of class 1 (0 where training had no such class), and null
    in a split. The score is the sum of the trees' leaves times their ``weight``. The trees are
    saved under ``path`` in their own layout and read from there. All inputs count as numbers.
    """
    scaler, ensemble = model.stages[-2:]
    ensemble.write().overwrite().save(path)
    scales = [(i, name, float(1 / std) if std else 0.0) for i, (name, std) in enumerate(zip(inputs, scaler.std))]
    features = F.broadcast(spark.createDataFrame(scales, "at int, feature string, scale double"))
    n = F.col("nodeData")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").drop("about")
    leaf = n["prediction"]
    if isinstance(ensemble, RandomForestClassificationModel):
        stats = n["impurityStats"]
        total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        leaf = F.coalesce(F.get(stats, F.lit(1)), F.lit(0.0)) / total
        weights = weights.select("tree", (F.col("weight") / ensemble.getNumTrees).alias("weight"))
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        n["split"]["featureIndex"].alias("at"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.when(n["leftChild"] >= 0, n["leftChild"]).alias("left"),
        F.when(n["rightChild"] >= 0, n["rightChild"]).alias("right"),
        F.when(n["leftChild"] < 0, leaf).alias("leaf"),
    )
    # Trees, nodes and inputs are bounded by the model's parameters.
    joined = nodes.join(features, "at", "left").join(F.broadcast(weights), "tree")
    return joined.select(*[c.split()[0] for c in SPLITS_SCHEMA.split(", ")])


def _number(value: float) -> str:
    """A double in SQL: only with an exponent is it no decimal; 17 digits bring back every bit."""
    return f"{value:.16e}"


def _tree_sql(nodes: dict[int, Row], at: int) -> str:
    n = nodes[at]
    if n.leaf is not None:
        return _number(n.leaf)
    left, right = _tree_sql(nodes, n.left), _tree_sql(nodes, n.right)
    return f"CASE WHEN {n.feature} * {_number(n.scale)} <= {_number(n.threshold)} THEN {left} ELSE {right} END"


def score_sql(splits: DataFrame) -> str:
    """The ensemble's score as one SQL expression over double columns, for any engine.

    A null or NaN input goes right wherever it is asked for. An ensemble without trees scores 0. The
    splits, which no table's size bears on, come to the driver.
    """
    trees: dict[int, dict[int, Row]] = defaultdict(dict)
    for row in splits.collect():
        trees[row.tree][row.node] = row
    terms = [f"{_number(nodes[0].weight)} * {_tree_sql(nodes, 0)}" for _, nodes in sorted(trees.items())]
    return " + ".join(terms) or _number(0.0)


def score_rows(rows: DataFrame, splits: DataFrame, column: str = "score") -> DataFrame:
    """``rows`` with the ensemble's score in ``column``; one projection, no Python and no shuffle."""
    return rows.withColumn(column, F.expr(score_sql(splits)))
