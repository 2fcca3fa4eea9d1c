"""Daily event counts and risk alerts from the event stream.

A file source stands in for the message broker. Every run drains what has
arrived and stops; offsets and state live in the checkpoint folder, so a
restarted run goes on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlight.functions.columns import surrogate_id
from martlight.functions.distribution import salted

# Files one micro-batch takes up, and keys one user's purchases spread over.
FILES_PER_BATCH = 1000
USER_SALTS = 8


def event_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Parquet files arriving in ``folder`` (or matching a glob) as a stream, in batches of bounded size."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def daily_event_counts(events: DataFrame, late_by: str = "1 hour") -> DataFrame:
    """Events per day and type; a day is final once the watermark has passed it."""
    return (
        events.withWatermark("event_ts", late_by)
        .groupBy(F.window("event_ts", "1 day").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.to_date(F.col("day.start")).alias("event_date"), "event_type", "events")
    )


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to parquet files, exactly once."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def risk_alerts(
    purchases: DataFrame, scores: DataFrame, threshold: float = 0.5, salts: int = USER_SALTS
) -> DataFrame:
    """Purchases of users whose score reaches ``threshold``; stream or batch against a static score table.

    Adaptive splitting does not reach streams, so a busy user's purchases are spread over ``salts`` keys.
    """
    risky = scores.where(F.col("risk_score") >= threshold).select("user_id", "risk_score")
    left, right = salted(
        purchases.where(F.col("event_type") == "purchase"), risky, spread_by=F.col("event_id"), salts=salts
    )
    return (
        left.join(right, ["user_id", "_salt"])
        .select(
            surrogate_id("event_id").alias("alert_id"), "event_id", "user_id", "event_ts", "risk_score"
        )
    )


def drain_alerts(alerts: DataFrame, path: str, checkpoint: str) -> None:
    """Write alerts batch by batch; a batch that is retried replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").orc(f"{path}/batch_id={batch_id}")

    query = (
        alerts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
