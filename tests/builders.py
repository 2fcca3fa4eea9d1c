"""Small literal tables for edge cases; columns not given are NULL."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, DecimalType, StructType, TimestampType

from martlight import schemas


def table(spark: SparkSession, schema: StructType, rows: list[dict]) -> DataFrame:
    def convert(field, value):
        if value is None:
            return None
        if isinstance(field.dataType, DecimalType):
            return Decimal(str(value))
        if isinstance(field.dataType, DateType) and isinstance(value, str):
            return dt.date.fromisoformat(value)
        if isinstance(field.dataType, TimestampType) and isinstance(value, str):
            return dt.datetime.fromisoformat(value)
        return value

    data = [tuple(convert(f, row.get(f.name)) for f in schema) for row in rows]
    return spark.createDataFrame(data, schema)


def orders(spark, rows):
    defaults = {"order_id": "o", "quantity": 1, "order_status": "Completed", "payment_method": "credit_card"}
    return table(spark, schemas.FACT_ORDER, [defaults | row for row in rows])


def users(spark, rows):
    return table(spark, schemas.DIM_USER, rows)


def products(spark, rows):
    return table(spark, schemas.DIM_PRODUCT, rows)


def vendors(spark, rows):
    defaults = {
        "vendor_rating": "4.00",
        "service_quality": "4.00",
        "avg_delivery_time": 5,
        "vendor_return_rate": "0.1000",
        "market_price": "100.00",
    }
    return table(spark, schemas.DIM_VENDOR, [defaults | row for row in rows])


def discounts(spark, rows):
    return table(spark, schemas.DIM_DISCOUNT, rows)


def events(spark, rows):
    return table(spark, schemas.FACT_EVENT, rows)


def as_dict(df: DataFrame, key: str) -> dict:
    return {row[key]: row.asDict() for row in df.collect()}
