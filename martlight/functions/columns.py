"""Scalar column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date


def as_date(value: DateLike | Column) -> Column:
    """A date column from a literal, so comparisons fold and reach the scan."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero.

    Going through a decimal first hides the last bits of floating noise, so a
    value that is a tie on paper rounds the same way however it was computed. A value
    too large for that has no such digits, and is rounded as it is.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share_where(condition: Column, counted: str) -> Column:
    """Aggregate: rows meeting ``condition`` over rows with ``counted`` present."""
    return ratio(F.count_if(condition), F.count(counted))


def main_category(category: str | Column) -> Column:
    """First level of a ``main>sub`` path."""
    return F.split(category, ">").getItem(0)


def leaf_category(category: str | Column) -> Column:
    """Last level of a ``main>sub`` path."""
    return F.element_at(F.split(category, ">"), -1)


def date_key(day: str | Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return F.date_format(day, "yyyyMMdd").try_cast("int")


def whole_days_between(end: Column, start: Column) -> Column:
    """Elapsed 24-hour days, rounded down also for negative spans."""
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    return F.floor(seconds / F.lit(86400.0)).cast("int")


def surrogate_id(*keys: str | Column) -> Column:
    """Repeatable text id from natural keys."""
    return F.sha2(F.concat_ws("-", *[F.col(k).cast("string") if isinstance(k, str) else k for k in keys]), 256)


def class_probability(vector: str | Column, label: int) -> Column:
    """Probability of one class out of a model's probability vector; 0 for a class never seen in training."""
    return F.coalesce(F.get(vector_to_array(vector), F.lit(label)), F.lit(0.0)).cast("float")


def returned() -> Column:
    return F.col("order_status") == "Returned"


def vendor_rating(
    cost_price: str = "cost_price",
    market_price: str = "market_price",
    return_rate: str = "vendor_return_rate",
    service_quality: str = "service_quality",
    delivery_days: str = "avg_delivery_time",
) -> Column:
    """Vendor rating on a 1-5 scale, two decimals, from price, quality and speed."""
    cost = F.col(cost_price).cast("double")
    market = F.col(market_price).cast("double")
    advantage = F.when(cost > 0, (market - cost) / cost).otherwise(0.0)
    # Component weights.
    score = (
        F.least(advantage, F.lit(1.0)) * 0.4
        + (1 - F.col(return_rate).cast("double")) * 0.3
        + F.col(service_quality).cast("double") / 5 * 0.2
        + (1 - F.col(delivery_days).cast("double") / 10) * 0.1
    )
    return half_up(1 + 4 * score, 2)
