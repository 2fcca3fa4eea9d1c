"""Risk scores of running features, by a saved model that may be replaced while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.functions.columns import DateLike
from martlight.operators.features import running_risk_features, user_order_aggregates
from martlight.operators.scoring import score_users
from martlight.session import hadoop_path, remove, store

Score = Callable[[DataFrame, PipelineModel], DataFrame]


def publish_model(spark: SparkSession, model: PipelineModel, folder: str) -> int:
    """Save a fitted pipeline as the next version below ``folder``; it is seen whole or not at all."""
    version = (newest_version(spark, folder) or 0) + 1
    draft, final = (f"{folder.rstrip('/')}/{n}" for n in (f"_draft-{version}", f"version={version}"))
    model.write().overwrite().save(draft)
    (source, files), (target, _) = hadoop_path(spark, draft), hadoop_path(spark, final)
    if not files.rename(source, target):
        raise OSError(f"cannot publish {final}")
    return version


def newest_version(spark: SparkSession, folder: str) -> int | None:
    path, files = hadoop_path(spark, folder)
    if not files.exists(path):
        return None
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=None)


def by_probability(as_of: DateLike) -> Score:
    """The class probability that the user-risk pipeline gives."""

    def score(features: DataFrame, model: PipelineModel) -> DataFrame:
        # The pipeline's input carries a label, which scoring does not read.
        return score_users(features.withColumn("label", F.lit(0.0)), model, as_of).select("user_id", "risk_score")

    return score


def drain_scores(
    orders: DataFrame,
    users: DataFrame,
    as_of: DateLike,
    models: str,
    path: str,
    checkpoint: str,
    score: Score | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> None:
    """Score each user anew whenever orders of theirs arrive.

    The stream keeps a few sums for each user as its state, so it is bounded by the users, and a busy user's
    orders are summed before they are shuffled. A batch holds the users whose sums have changed; they are
    scored by the newest version below ``models``, looked up for each batch. A batch that is retried
    replaces its own rows. ``after_batch`` is told each batch that is written.
    """
    spark = orders.sparkSession
    score = score or by_probability(as_of)
    loaded: dict[int, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        version = newest_version(spark, models)
        if version is None:
            raise FileNotFoundError(f"no model below {models}")
        if version not in loaded:
            loaded.clear()
            loaded[version] = PipelineModel.load(f"{models.rstrip('/')}/version={version}")
        # Stored, so that the stream's state is worked on once a batch.
        sums, folder = store(batch, "running-features")
        scored = score(running_risk_features(sums, users, as_of), loaded[version])
        scored.withColumn("model", F.lit(version)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        remove(spark, folder)
        if after_batch is not None:
            after_batch(batch_id)

    query = (
        user_order_aggregates(orders)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_scores(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, risk_score, model) as each user was scored last."""
    rows = spark.read.parquet(path)
    last = F.max_by(F.struct("risk_score", "model"), "batch_id")
    return rows.groupBy("user_id").agg(last.alias("last")).select("user_id", "last.*")
