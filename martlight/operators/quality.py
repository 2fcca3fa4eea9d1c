"""Declared constraints of the warehouse as audits, and table profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns declared NOT NULL.
NOT_NULL = {
    "fact_order": [
        "order_id",
        "user_id",
        "product_id",
        "time_id",
        "vendor_id",
        "quantity",
        "gross_amount",
        "discount_amount",
        "net_amount",
        "payment_method",
        "purchase_channel",
    ],
    "user_behavior_profile": ["user_id"],
    "coupon_strategy": [
        "strategy_id",
        "min_discount_sensitivity",
        "min_view_count",
        "min_cart_count",
        "trigger_type",
        "action_type",
        "coupon_id",
    ],
}

# Declared CHECK conditions.
PAYMENT_METHODS = ["credit_card", "third_party", "prepaid_card", "wire_transfer", "unionpay"]
CHECKED_CHANNELS = ["web", "mobile_app", "mini_program"]
TRIGGER_TYPES = ["view", "cart_add"]
ACTION_TYPES = ["popup", "push", "sms"]


def declared_checks(table: str) -> dict[str, Column]:
    """CHECK conditions of a table by the name of the column they guard."""
    if table == "fact_order":
        return {
            "quantity": F.col("quantity") > 0,
            "gross_amount": F.col("gross_amount") > 0,
            "discount_amount": F.col("discount_amount") >= 0,
            "net_amount": F.col("net_amount") >= 0,
            "payment_method": F.col("payment_method").isin(PAYMENT_METHODS),
            "purchase_channel": F.col("purchase_channel").isin(CHECKED_CHANNELS),
        }
    if table == "user_behavior_profile":
        return {
            "avg_research_time": F.col("avg_research_time") > 0,
            "decision_time": F.col("decision_time") > 0,
            "purchase_intensity": F.col("purchase_intensity").between(0, 1),
            "social_influence_factor": F.col("social_influence_factor").between(0, 1),
        }
    if table == "coupon_strategy":
        return {
            "min_discount_sensitivity": F.col("min_discount_sensitivity").between(0, 1),
            "min_view_count": F.col("min_view_count") >= 0,
            "min_cart_count": F.col("min_cart_count") >= 0,
            "trigger_type": F.col("trigger_type").isin(TRIGGER_TYPES),
            "action_type": F.col("action_type").isin(ACTION_TYPES),
        }
    return {}


def _count_violations(df: DataFrame, table: str, broken: Mapping[str, Column]) -> DataFrame:
    """One pass over ``df`` for all rules, then one output row per rule."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in broken.items()])
    return (
        counted.unpivot([], list(broken), "column_name", "violations")
        .withColumn("table_name", F.lit(table))
        .select("table_name", "column_name", "violations")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def not_null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows breaking NOT NULL, per declared column of the given tables."""
    return _union(
        [_count_violations(df, t, {c: F.col(c).isNull() for c in NOT_NULL[t]}) for t, df in tables.items()]
    )


def check_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows breaking a CHECK, per declared condition; NULL passes, as in SQL."""
    return _union(
        [_count_violations(df, t, {c: ~ok for c, ok in declared_checks(t).items()}) for t, df in tables.items()]
    )


def failing_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows breaking any NOT NULL or CHECK of ``table``, with the columns at fault."""
    broken = {f"{c} NOT NULL": F.col(c).isNull() for c in NOT_NULL.get(table, [])}
    broken |= {f"{c} CHECK": ~ok for c, ok in declared_checks(table).items()}
    named = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in broken.items()]))
    return df.withColumn("violations", named).where(F.size("violations") > 0)


def with_discount_rate(orders: DataFrame) -> DataFrame:
    """Add the generated column: discount over gross, NULL for a zero gross or a rate the type cannot hold."""
    rate = F.try_divide("discount_amount", "gross_amount")
    return orders.withColumn("discount_rate", rate.try_cast("decimal(5,4)"))


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return _union(counts)


def preview(df: DataFrame, rows: int = 5, *order_by: str) -> DataFrame:
    """A few rows to look at: any, or the first by ``order_by``."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
