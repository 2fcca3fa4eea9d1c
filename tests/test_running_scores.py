"""A saved model inside the stream: equal to batch scoring, and replaced between two batches."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from martlight.operators import features, scoring
from martlight.session import shared_dir
from martlight.streaming import scores
from tests import builders as b

AS_OF = "2025-02-01"


def _orders(spark, first, last, users):
    return b.orders(
        spark,
        [{"order_id": str(i), "user_id": i % users, "product_id": 1, "net_amount": i % 90, "discount_amount": i % 7,
          "order_status": "Returned" if i % 5 == 0 else "Completed", "payment_method": "prepaid_card" if i % 3 else "credit_card",
          "order_date": f"2025-01-{1 + i % 28:02d}"} for i in range(first, last)],
    )


def _users(spark, n):
    return b.users(spark, [{"user_id": i, "registration_date": f"2024-0{1 + i % 9}-01", "credit_score": 300 + 7 * (i % 80)} for i in range(n)])


def _stream(spark, base, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")


def test_stream_scores_equal_batch_scores(spark):
    """The user-risk forest on running features: after the last batch, every user's score is the batch's."""
    base = shared_dir(spark, "scores")
    users, orders = _users(spark, 120), _orders(spark, 0, 900, 100)
    labelled = features.user_risk_labels(orders, users, AS_OF)
    model = scoring.fit_user_risk(labelled, trees=5).model
    scores.publish_model(spark, model, f"{base}/models")
    for i in range(3):
        orders.where(F.col("order_id").cast("int") % 3 == i).coalesce(1).write.parquet(f"{base}/in/part={i}")
    scores.drain_scores(_stream(spark, base, orders.schema), users, AS_OF, f"{base}/models", f"{base}/out", f"{base}/checkpoint")
    streamed = {r.user_id: (r.risk_score, r.model) for r in scores.latest_scores(spark, f"{base}/out").collect()}
    batch = scoring.score_users(labelled.where("frequency > 0"), model, AS_OF)
    assert streamed == {r.user_id: (r.risk_score, 1) for r in batch.collect()} and len(streamed) == 100


def test_model_is_replaced_between_batches(spark):
    base = shared_dir(spark, "scores")
    users, orders = _users(spark, 20), _orders(spark, 0, 60, 20)

    def constant(value):
        stage = SQLTransformer(statement=f"SELECT *, CAST({value} AS DOUBLE) AS risk_score FROM __THIS__")
        return Pipeline(stages=[stage]).fit(users)

    scores.publish_model(spark, constant(0.1), f"{base}/models")
    orders.where("user_id < 15").coalesce(1).write.parquet(f"{base}/in/part=0")
    orders.where("user_id >= 10").coalesce(1).write.parquet(f"{base}/in/part=1")

    def publish(batch_id):
        if batch_id == 0:
            scores.publish_model(spark, constant(0.2), f"{base}/models")

    scores.drain_scores(
        _stream(spark, base, orders.schema), users, AS_OF, f"{base}/models", f"{base}/out", f"{base}/checkpoint",
        score=lambda rows, model: model.transform(rows).select("user_id", "risk_score"), after_batch=publish,
    )
    found = {r.user_id: (r.risk_score, r.model) for r in scores.latest_scores(spark, f"{base}/out").collect()}
    assert found == {u: (0.1, 1) if u < 10 else (0.2, 2) for u in range(20)}
