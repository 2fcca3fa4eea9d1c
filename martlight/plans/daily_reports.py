"""Reports kept up to date by day: partial sums per order date, of which only replaced days are computed again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from martlight.functions.columns import DateLike, as_date
from martlight.operators import bi
from martlight.session import remove
from martlight.sources.ledger import LoadRecord
from martlight.sources.warehouse import hadoop_exists, partition_folder

_SUM = DecimalType(22, 2)
# What a partial row is counted by, and the sums it holds. All of them add up over days.
_KEYS = {"product_sales": ["product_id"], "city_demand": ["province", "city"]}
_SCHEMAS = {
    "product_sales": StructType(
        [StructField("product_id", LongType()), StructField("net_amount", _SUM), StructField("order_date", DateType())]
    ),
    "city_demand": StructType(
        [
            StructField("province", StringType()),
            StructField("city", StringType()),
            StructField("orders", LongType()),
            StructField("quantity", LongType()),
            StructField("net_amount", _SUM),
            StructField("order_date", DateType()),
        ]
    ),
}


def loaded_days(record: LoadRecord) -> list[dt.date]:
    """The days that a load of the order fact has replaced."""
    return [dt.date.fromisoformat(p.removeprefix("order_date=")) for p in record.partitions if not p.endswith("__")]


def day_partials(orders: DataFrame, name: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """Partial sums of ``orders`` by day and key; with ``days`` only their partitions are read."""
    if days is not None:
        orders = orders.where(F.col("order_date").isin(list(days)))
    sums = {
        "orders": F.count("order_id"),
        "quantity": F.sum("quantity").cast("long"),
        "net_amount": F.sum("net_amount").cast(_SUM),
    }
    kept = [sums[f.name].alias(f.name) for f in _SCHEMAS[name] if f.name in sums]
    return orders.groupBy("order_date", *_KEYS[name]).agg(*kept).select(*_SCHEMAS[name].fieldNames())


class DailyReports:
    """Partial sums of the order fact below ``path``, one folder a day, and the reports that merge them.

    A report reads a row a day and key in place of the orders, and equals the report over the orders
    themselves. Orders without a date are in none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def partials(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(_SCHEMAS[name])
        where = f"{self.path}/{name}"
        return reader.parquet(where) if hadoop_exists(self.spark, where) else self.spark.createDataFrame([], _SCHEMAS[name])

    def refresh(self, orders: DataFrame, days: Iterable[dt.date]) -> None:
        """Compute the partials of ``days`` again from the order fact; those of other days stay as they are.

        Doing it twice changes nothing. A day that has no orders any more loses its folder.
        """
        days = sorted(set(days))
        if not days:
            return
        for name in _KEYS:
            where = f"{self.path}/{name}"
            rows = day_partials(orders, name, days).hint("rebalance", "order_date")
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("order_date").parquet(where)
            left = orders.where(F.col("order_date").isin(days)).select("order_date").distinct()
            for day in set(days) - {r.order_date for r in left.collect()}:
                folder = f"{where}/{partition_folder(self.spark, 'fact_order', order_date=day)}"
                if hadoop_exists(self.spark, folder):
                    remove(self.spark, folder)

    def category_sales_share(self, products: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
        """``bi.category_sales_share`` of the days from ``start`` to ``end``."""
        return bi.category_sales_share(self.partials("product_sales"), products, start, end)

    def warehouse_demand_top(self, since: DateLike, k: int = 20) -> DataFrame:
        """``bi.warehouse_demand_top`` of the days from ``since`` on."""
        summed = (
            self.partials("city_demand")
            .where(F.col("order_date") >= as_date(since))
            .groupBy("province", "city")
            .agg(
                F.sum("orders").alias("total_orders"),
                F.sum("quantity").alias("total_quantity"),
                F.sum("net_amount").alias("total_sales"),
            )
        )
        return summed.orderBy(F.desc("total_orders"), F.desc("total_sales"), "province", "city").limit(k)
