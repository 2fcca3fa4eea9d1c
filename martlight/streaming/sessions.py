"""Session funnel from the event stream: a row for each session once it closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def closed_sessions(events: DataFrame, gap: str = "30 minutes", late_by: str = "1 hour") -> DataFrame:
    """(session_id, opened, closed, viewed, carted, bought, events) of every session that no event can prolong.

    A session is an id's events with no more than ``gap`` between two of them. Its state is a few flags
    and its span; a timer at its end plus ``late_by`` emits and forgets it. Events of a very busy
    session are merged in each task before they are shuffled, so its size costs no state and little traffic.
    """

    def reached(kind: str) -> Column:
        return F.coalesce(F.bool_or(F.col("event_type") == kind), F.lit(False))

    # The stream's own merge of a session's parts within a task comes before the shuffle.
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        events.withWatermark("event_ts", late_by)
        .groupBy("session_id", F.session_window("event_ts", gap).alias("span"))
        .agg(
            reached("view").alias("viewed"),
            reached("cart_add").alias("carted"),
            reached("purchase").alias("bought"),
            F.count(F.lit(1)).alias("events"),
        )
        .select("session_id", F.col("span.start").alias("opened"), F.col("span.end").alias("closed"), "viewed", "carted", "bought", "events")
    )
