"""AUC from ranks, leaves of open attributes, and sessions of a stream that close."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from martlight.operators import rules, scoring
from martlight.plans import registry
from martlight.session import shared_dir
from martlight.sources.testdata import SNAPSHOT_DATE, TestdataWarehouse
from martlight.streaming import sessions
from martlight.streaming.events import drain_to_files, event_stream
from tests import builders as b

RANK_SUM = """
WITH ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS r FROM scored),
total AS (SELECT count(*) AS n, sum(label) AS bad, sum(r) FILTER (label = 1) AS ranks FROM ranked)
SELECT (ranks - bad * (bad + 1) / 2) / (bad * (n - bad)), n FROM total"""


@pytest.mark.parametrize("distinct", [1, 3, 5000])
def test_rank_auc_with_ties(spark, distinct):
    rng = random.Random(distinct)
    rows = [(float(rng.randrange(distinct)), float(rng.random() < 0.3)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "score double, label double").repartition(7)
    found = scoring.rank_auc(frame, "score", "label").first()
    good, bad = [s for s, y in rows if y == 1], sorted(s for s, y in rows if y == 0)
    import bisect

    wins = sum(bisect.bisect_left(bad, s) + bisect.bisect_right(bad, s) for s in good) / 2
    assert found.test_rows == 3000 and found.value == pytest.approx(wins / len(good) / len(bad), abs=1e-6)


def test_rank_auc_without_a_side(spark):
    for rows in ([], [(1.0, 1.0)], [(1.0, 0.0)], [(None, 1.0), (float("nan"), 0.0)]):
        assert scoring.rank_auc(spark.createDataFrame(rows, "score double, label double"), "score", "label").first().value is None


def test_rank_auc_of_the_models_scores(spark, sf_dir):
    """What the fitted model says of the held-out users, against SQL's rank sum of the same scores."""
    w = TestdataWarehouse(spark, sf_dir)
    labels = registry.features.user_risk_labels(*registry._risk_inputs(w), SNAPSHOT_DATE).select("user_id", "label")
    scored = registry.user_risk_scores(w).join(scoring.train_test_split(labels, "user_id")[1], "user_id")
    scored = scored.select(F.col("risk_score").cast("double").alias("score"), "label").toPandas()
    ours = scoring.rank_auc(spark.createDataFrame(scored), "score", "label").first()
    con = duckdb.connect()
    con.register("scored", scored)
    value, n = con.execute(RANK_SUM).fetchone()
    assert ours.test_rows == n and ours.value == pytest.approx(value, abs=1e-6)
    # The model's own metric is measured on its raw votes, which the stored scores keep the order of.
    assert ours.value == pytest.approx(registry._user_fit(w)[0].metric, abs=1e-3)


def test_leaves_of_any_attributes(spark):
    texts = {
        1: '{"color": "red", "size": {"eu": 42, "us": [8, "8.5"]}, "tags": [], "none": null}',
        2: '["a", {"b": true}]',
        3: "not json",
        4: None,
        5: "{}",
        6: '"plain"',
    }
    products = b.products(spark, [{"product_id": k, "implicit_attributes": t} for k, t in texts.items()])
    found = {(r.product_id, r.path): r.value for r in rules.attribute_leaves(products).collect()}
    assert found == {
        (1, "color"): "red", (1, "size.eu"): "42", (1, "size.us[0]"): "8", (1, "size.us[1]"): "8.5", (1, "none"): None,
        (2, "[0]"): "a", (2, "[1].b"): "true", (6, ""): "plain",
    }


def test_sessions_close_and_a_hot_one_is_one_row(spark):
    base = shared_dir(spark, "sessions")
    hot = spark.range(20_000).selectExpr("'hot' AS session_id", "IF(id % 2 = 0, 'view', 'cart_add') AS event_type", "timestamp_seconds(1735689600 + id % 3600) AS event_ts")
    rest = spark.createDataFrame(
        [("a", "view", "2025-01-01 00:00:00"), ("a", "purchase", "2025-01-01 00:20:00"), ("a", "view", "2025-01-01 02:00:00"),
         ("b", "view", "2025-01-01 23:30:00"), ("z", "view", "2025-01-02 00:00:00"), ("z", None, None)],
        "session_id string, event_type string, t string",
    ).selectExpr("session_id", "event_type", "CAST(t AS TIMESTAMP) AS event_ts")
    hot.union(rest).repartition(3).write.parquet(f"{base}/in")
    stream = event_stream(spark, f"{base}/in", hot.schema)
    closed = sessions.closed_sessions(stream, gap="30 minutes", late_by="1 hour")
    drain_to_files(closed, f"{base}/out", f"{base}/checkpoint")
    found = sorted((r.session_id, str(r.opened)[11:16], r.viewed, r.carted, r.bought, r.events) for r in spark.read.schema(closed.schema).parquet(f"{base}/out").collect())
    # Those of b and z may still go on.
    assert found == [("a", "00:00", True, False, True, 2), ("a", "02:00", True, False, False, 1), ("hot", "00:00", True, True, False, 20_000)]
