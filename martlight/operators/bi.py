"""Business-intelligence reports over the order fact.

Each one shrinks the fact to one row per dimension key before joining the
dimension. A key holding a third of all orders then costs its join no more
than any other, and the join itself needs no second shuffle of the fact.
Dimension keys are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martlight.functions.columns import DateLike, as_date, half_up, main_category, ratio, returned


def category_sales_share(orders: DataFrame, products: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Net sales per main category in [start, end] and their percentage of the total."""
    per_product = (
        orders.where(F.col("order_date").between(as_date(start), as_date(end)))
        .groupBy("product_id")
        .agg(F.sum("net_amount").alias("net"))
    )
    per_category = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy(main_category("category").alias("main_category"))
        .agg(F.sum("net").alias("total_sales"))
    )
    # One value, read from the same shuffle: no window over all categories in one task.
    grand_total = per_category.agg(F.sum("total_sales")).scalar()
    percentage = ratio(F.col("total_sales") * 100, grand_total)
    return per_category.select(
        "main_category", "total_sales", half_up(percentage, 2).alias("sales_percentage")
    ).orderBy(F.desc("total_sales"), "main_category")


def repurchase_cycle_days(orders: DataFrame) -> DataFrame:
    """Mean days between consecutive purchase dates of a user, over all gaps.

    The gaps of one user add up to last minus first date, so neither a sort nor
    a window is needed.
    """
    days = orders.select("user_id", "order_date").distinct()
    per_user = days.groupBy("user_id").agg(
        F.datediff(F.max("order_date"), F.min("order_date")).alias("span"),
        F.greatest(F.count("order_date") - 1, F.lit(0)).alias("gaps"),
    )
    return per_user.agg(
        half_up(ratio(F.sum("span"), F.sum("gaps")), 2).alias("avg_repurchase_cycle_days")
    )


def repurchase_gaps(orders: DataFrame) -> DataFrame:
    """Every gap between consecutive purchase dates: user_id, order_date, gap_days.

    De-duplicating first leaves a user at most one row per calendar day, which
    bounds the window however many orders the user has.
    """
    by_user = Window.partitionBy("user_id").orderBy("order_date")
    return (
        orders.select("user_id", "order_date")
        .distinct()
        .withColumn("previous_date", F.lag("order_date", 1).over(by_user))
        .where(F.col("previous_date").isNotNull())
        .select("user_id", "order_date", F.datediff("order_date", "previous_date").alias("gap_days"))
    )


def coupon_roi(orders: DataFrame, discounts: DataFrame) -> DataFrame:
    """Orders, sales, cost and return on cost per discount name and type."""
    per_discount = (
        orders.where(F.col("discount_id").isNotNull())
        .groupBy("discount_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("net_amount").alias("sales"),
            F.sum("discount_amount").alias("cost"),
        )
    )
    sales, cost = F.col("sales_with_coupon"), F.col("total_discount_cost")
    return (
        per_discount.join(discounts.select("discount_id", "discount_name", "discount_type"), "discount_id")
        .groupBy("discount_name", "discount_type")
        .agg(
            F.sum("orders").alias("orders_with_coupon"),
            F.sum("sales").alias("sales_with_coupon"),
            F.sum("cost").alias("total_discount_cost"),
        )
        .withColumn("coupon_roi", half_up(ratio(sales - cost, cost), 2))
        .orderBy(F.desc_nulls_last("coupon_roi"), "discount_name", "discount_type")
    )


def vendor_value(orders: DataFrame, vendors: DataFrame) -> DataFrame:
    """Cost, gross sales and value score of every vendor with orders."""
    per_vendor = orders.groupBy("vendor_id").agg(
        F.sum("quantity").alias("units"), F.sum("gross_amount").alias("total_gross_sales")
    )
    cost, gross = F.col("total_cost"), F.col("total_gross_sales")
    # Weights of margin, rating and return rate.
    score = (
        ratio(gross - cost, cost) * 0.5
        + F.col("vendor_rating").cast("double") * 0.3
        + (1 - F.col("vendor_return_rate").cast("double")) * 0.2
    )
    return (
        per_vendor.join(
            vendors.select("vendor_id", "vendor_name", "vendor_rating", "vendor_return_rate", "cost_price"),
            "vendor_id",
        )
        .withColumn("total_cost", F.col("units").cast("decimal(20,0)") * F.col("cost_price"))
        .select(
            "vendor_id",
            "vendor_name",
            "vendor_rating",
            "vendor_return_rate",
            "total_cost",
            "total_gross_sales",
            half_up(score, 4).alias("value_score"),
        )
    )


def vendor_value_top(orders: DataFrame, vendors: DataFrame, k: int = 10) -> DataFrame:
    """The k vendors with the best value score."""
    return vendor_value(orders, vendors).orderBy(F.desc_nulls_last("value_score"), "vendor_id").limit(k)


def warehouse_demand_top(orders: DataFrame, since: DateLike, k: int = 20) -> DataFrame:
    """The k cities with most orders from ``since`` on."""
    return (
        orders.where(F.col("order_date") >= as_date(since))
        .groupBy("province", "city")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("net_amount").alias("total_sales"),
        )
        .orderBy(F.desc("total_orders"), F.desc("total_sales"), "province", "city")
        .limit(k)
    )


def user_credit_metrics(
    orders: DataFrame, users: DataFrame, as_of: DateLike, window_days: int = 90
) -> DataFrame:
    """Returns, spend, order value and tenure of users active in the look-back window."""
    recent = orders.where(F.col("order_date") > F.date_sub(as_date(as_of), window_days))
    per_user = recent.groupBy("user_id").agg(
        F.max(F.when(returned(), 1).otherwise(0)).alias("has_returned_recently"),
        F.sum("net_amount").alias("total_spend"),
        ratio(F.sum("net_amount"), F.count("net_amount")).alias("avg_order_value"),
    )
    return per_user.join(users.select("user_id", "registration_date"), "user_id").select(
        "user_id",
        "has_returned_recently",
        "total_spend",
        "avg_order_value",
        F.datediff(as_date(as_of), "registration_date").alias("tenure_days"),
    )


def user_credit_rating(
    orders: DataFrame, users: DataFrame, as_of: DateLike, window_days: int = 90
) -> DataFrame:
    """Credit rating of every user active in the look-back window, biggest spender first."""
    spend, tenure = F.col("total_spend"), F.col("tenure_days")
    # Thresholds and names of the ratings.
    rating = (
        F.when(F.col("has_returned_recently") == 1, "Low")
        .when((spend > 5000) & (F.col("avg_order_value") > 500) & (tenure > 180), "High")
        .when((spend > 1000) & (tenure > 90), "Medium")
        .otherwise("Standard")
    )
    return (
        user_credit_metrics(orders, users, as_of, window_days)
        .orderBy(F.desc_nulls_last("total_spend"), "user_id")
        .select("user_id", rating.alias("credit_rating"))
    )


def top_risk_users(scores: DataFrame, k: int = 20) -> DataFrame:
    """The k rows of a user score table with the highest risk."""
    return scores.orderBy(F.desc_nulls_last("risk_score"), "user_id").limit(k)


def top_vendors_by_score(scores: DataFrame, vendors: DataFrame, k: int = 10) -> DataFrame:
    """Names and scores of the k best vendors in a vendor score table."""
    names = vendors.select("vendor_id", "vendor_name")
    return (
        scores.select("vendor_id", "performance_score")
        .join(names, "vendor_id")
        .orderBy(F.desc_nulls_last("performance_score"), "vendor_id")
        .limit(k)
        .select("vendor_name", "performance_score")
    )
