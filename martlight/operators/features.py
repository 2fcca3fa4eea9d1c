"""Feature tables and rule labels for the user-risk and vendor-performance models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import DateLike, as_date, ratio, returned, share_where


@dataclass(frozen=True)
class RiskRules:
    """Thresholds that mark a user as high risk; a rule set to None is not applied."""

    min_return_rate: float
    min_prepaid_orders: int
    min_credit_score: int
    recency_days: int | None = None
    recent_spend: int | None = None

    def label(self) -> Column:
        """1.0 for high risk, else 0.0; the first rule that holds decides, NULL never holds."""
        heavy_returns = (F.col("return_rate_model") > self.min_return_rate) & (
            F.col("prepaid_card_count") > self.min_prepaid_orders
        )
        risky = F.when(heavy_returns, 1.0).when(F.col("credit_score") < self.min_credit_score, 1.0)
        if self.recency_days is not None and self.recent_spend is not None:
            burst = (F.col("recency") < self.recency_days) & (F.col("monetary") > self.recent_spend)
            risky = risky.when(burst, 1.0)
        return risky.otherwise(0.0)


# Thresholds of the current and of the earlier rule set.
CURRENT_RULES = RiskRules(
    min_return_rate=0.6, min_prepaid_orders=1, min_credit_score=400, recency_days=10, recent_spend=5000
)
EARLIER_RULES = RiskRules(min_return_rate=0.5, min_prepaid_orders=0, min_credit_score=450)

# Fixed value: recency of a user who never bought anything.
NEVER_PURCHASED = 999

_ORDER_FEATURES = ["frequency", "monetary", "avg_discount", "return_rate_model", "prepaid_card_count"]


def user_order_aggregates(orders: DataFrame) -> DataFrame:
    """Recency, frequency, money and behaviour of each user with orders."""
    return orders.groupBy("user_id").agg(
        F.max("order_date").alias("last_purchase_date"),
        F.count("order_id").alias("frequency"),
        F.sum("net_amount").alias("monetary"),
        F.avg("discount_amount").alias("avg_discount"),
        share_where(returned(), "order_id").alias("return_rate_model"),
        F.count_if(F.col("payment_method") == "prepaid_card").alias("prepaid_card_count"),
    )


def _with_ages(features: DataFrame, as_of: DateLike) -> DataFrame:
    return features.withColumns(
        {
            "recency": F.datediff(as_date(as_of), "last_purchase_date"),
            "user_tenure": F.datediff(as_date(as_of), "registration_date"),
        }
    )


def user_risk_features(orders: DataFrame, users: DataFrame, as_of: DateLike) -> DataFrame:
    """One feature row per user in ``users``, with or without orders."""
    return _filled_features(user_order_aggregates(orders), users, as_of, "right")


def running_risk_features(aggregates: DataFrame, users: DataFrame, as_of: DateLike) -> DataFrame:
    """Feature rows of the users in ``aggregates``, as far as ``users`` knows them."""
    return _filled_features(aggregates, users, as_of, "inner")


def _filled_features(aggregates: DataFrame, users: DataFrame, as_of: DateLike, how: str) -> DataFrame:
    profile = users.select("user_id", "registration_date", "credit_score")
    return (
        _with_ages(aggregates.join(profile, "user_id", how), as_of)
        .na.fill(0, subset=_ORDER_FEATURES)
        .na.fill(NEVER_PURCHASED, subset=["recency"])
    )


def user_risk_labels(
    orders: DataFrame, users: DataFrame, as_of: DateLike, rules: RiskRules = CURRENT_RULES
) -> DataFrame:
    """``user_risk_features`` plus the rule label."""
    return user_risk_features(orders, users, as_of).withColumn("label", rules.label())


def user_risk_labels_v1(
    orders: DataFrame, users: DataFrame, as_of: DateLike, rules: RiskRules = EARLIER_RULES
) -> DataFrame:
    """Earlier variant: users with orders only, VIP level kept, every numeric NULL set to 0 after labelling."""
    profile = users.select("user_id", "registration_date", "vip_level", "credit_score")
    joined = user_order_aggregates(orders).join(profile, "user_id")
    return _with_ages(joined, as_of).withColumn("label", rules.label()).na.fill(0)


def vendor_price_aggregates(products: DataFrame) -> DataFrame:
    """Sum and number of the prices of each vendor's products."""
    return products.groupBy("vendor_id").agg(
        F.sum("unit_price").alias("prices"), F.count("unit_price").alias("priced")
    )


def _mean_margin() -> Column:
    """Mean of (price - cost) / cost over a vendor's products.

    A vendor has one cost price, so the mean follows from the exact sum of the
    prices and products need not be joined to vendors row by row.
    """
    total_cost = F.col("cost_price") * F.col("priced").cast("decimal(20,0)")
    return ratio(F.col("prices") - total_cost, total_cost)


def vendor_profit_margin(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Mean margin over cost of each vendor with products."""
    costs = vendors.select("vendor_id", "cost_price")
    return (
        vendor_price_aggregates(products)
        .join(costs, "vendor_id")
        .select("vendor_id", _mean_margin().alias("avg_profit_margin"))
    )


def vendor_order_aggregates(orders: DataFrame) -> DataFrame:
    """Order count, value and return rate of each vendor with orders."""
    return orders.groupBy("vendor_id").agg(
        F.count("order_id").alias("sales_volume"),
        F.sum("net_amount").alias("sales_value"),
        share_where(returned(), "order_id").alias("order_return_rate"),
    )


def vendor_features(orders: DataFrame, products: DataFrame, vendors: DataFrame) -> DataFrame:
    """One feature row per vendor; every numeric NULL becomes 0."""
    return (
        vendors.join(vendor_price_aggregates(products), "vendor_id", "left")
        .withColumn("avg_profit_margin", _mean_margin())
        .drop("prices", "priced")
        .join(vendor_order_aggregates(orders), "vendor_id", "left")
        .na.fill(0)
    )


def vendor_performance_labels(features: DataFrame) -> DataFrame:
    """Add the weighted performance label to ``vendor_features``."""
    # Weights of rating, margin, return rate and delivery time.
    label = (
        F.col("vendor_rating").cast("double") * 0.4
        + F.col("avg_profit_margin") * 0.3
        + (1 - F.col("order_return_rate")) * 0.2
        + (1 - F.col("avg_delivery_time").cast("double") / 10) * 0.1
    )
    return features.withColumn("performance_label", label)
