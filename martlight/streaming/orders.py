"""Order facts from a stream of events that may come late and more than once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.operators.rules import orders_from_events
from martlight.session import remove, store
from martlight.sources.warehouse import Warehouse, hadoop_exists, replace_partitions


def once(events: DataFrame, late_by: str) -> DataFrame:
    """Each event of a stream once, by its id; repeats and new events may come up to ``late_by`` late.

    Ids are kept no longer than that, so the state is bounded by the events of a span of time. Events that
    are later still are dropped by the stream, and counted in its progress.
    """
    return events.withWatermark("event_ts", late_by).dropDuplicatesWithinWatermark(["event_id"])


def upsert_orders(orders: DataFrame, path: str) -> None:
    """Put orders into the fact table's files below ``path``: of one order id the new row stays.

    Only the days that ``orders`` has are read and written again, so the same orders put in twice change
    nothing. Of repeats within ``orders`` the least row stays.
    """
    spark = orders.sparkSession
    rows, folder = store(orders, "upsert")
    days = rows.select("order_date").distinct()
    least = rows.groupBy("order_date", "order_id").agg(F.min(F.struct(*orders.columns)).alias("row")).select("row.*")
    found = [folder]
    if hadoop_exists(spark, f"{path.rstrip('/')}/fact_order"):
        # A join on the day prunes the folders that are listed; what they hold is stored before they are replaced.
        old = Warehouse(spark, path=path).table("fact_order").join(F.broadcast(days), "order_date", "left_semi")
        # Merged: a broadcast would send the keys of all orders that came through the driver.
        keys = least.select("order_date", "order_id").hint("merge")
        kept = old.join(keys, ["order_date", "order_id"], "left_anti")
        least, merged = store(least.unionByName(kept.select(least.columns)), "upsert-merged")
        found.append(merged)
    replace_partitions(least, "fact_order", path)
    for part in found:
        remove(spark, part)


def drain_orders(
    events: DataFrame,
    products: DataFrame,
    users: DataFrame,
    discounts: DataFrame,
    as_of: str | dt.datetime,
    path: str,
    checkpoint: str,
    late_by: str = "1 day",
) -> None:
    """Turn every purchase that has arrived into one order in the fact table below ``path``.

    A batch that is retried, or an event that comes again after its id was forgotten, puts the same
    order in once more, under the same id.
    """

    spark = products.sparkSession
    # Else a table below a broadcast's limit would go through the driver again with every batch.
    merged = [products.hint("merge"), users.hint("merge")]

    def write(batch: DataFrame, batch_id: int) -> None:
        # Stored, so that the stream's state is worked on once a batch, and read back by the tables' session:
        # in the stream's own, no plan adapts, so every shuffle has its full number of tasks and hot keys aren't split.
        folder = store(batch, "order-batch")[1]
        rows = spark.read.schema(batch.schema).parquet(folder)
        upsert_orders(orders_from_events(rows, *merged, discounts, as_of), path)
        remove(spark, folder)

    query = (
        once(events.where(F.col("event_type") == "purchase"), late_by)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
