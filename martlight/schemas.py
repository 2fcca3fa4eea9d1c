"""Declared schema, keys and layout of every warehouse table.

Nothing in the library infers a schema. Column names, types, partition columns
and bucket counts are the fixed data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    ByteType,
    CharType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_MONEY = DecimalType(12, 2)
_PRICE = DecimalType(10, 2)
_SHARE = DecimalType(5, 4)
_SHORT_SHARE = DecimalType(5, 2)
_GRADE = DecimalType(3, 2)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Columns and types of the warehouse tables, partition columns last.
DIM_USER = _table(
    user_id=LongType(),
    user_name=StringType(),
    gender=StringType(),
    age=ShortType(),
    email=StringType(),
    phone=StringType(),
    province=StringType(),
    city=StringType(),
    registration_date=DateType(),
    last_login=TimestampType(),
    vip_level=ByteType(),
    discount_sensitivity=_SHARE,
    return_rate=_SHARE,
    credit_score=IntegerType(),
    country=StringType(),
)

DIM_PRODUCT = _table(
    product_id=LongType(),
    category=StringType(),
    brand=StringType(),
    unit_price=_PRICE,
    stock=IntegerType(),
    description=StringType(),
    implicit_attributes=StringType(),
    vendor_id=LongType(),
)

DIM_VENDOR = _table(
    vendor_id=LongType(),
    vendor_name=StringType(),
    cost_price=_PRICE,
    market_price=_PRICE,
    vendor_rating=_GRADE,
    service_quality=_GRADE,
    avg_delivery_time=IntegerType(),
    vendor_return_rate=_SHARE,
    distribution_areas=ArrayType(StringType()),
    country=StringType(),
)

DIM_DISCOUNT = _table(
    discount_id=LongType(),
    discount_name=StringType(),
    discount_type=StringType(),
    threshold_amount=_MONEY,
    discount_value=_PRICE,
    valid_from=TimestampType(),
    valid_to=TimestampType(),
)

DIM_TIME = _table(
    time_id=IntegerType(),
    dt=DateType(),
    year=ShortType(),
    quarter=ByteType(),
    month=ByteType(),
    day=ByteType(),
    hour=ByteType(),
    minute=ByteType(),
    day_of_week=ByteType(),
    is_weekend=ByteType(),
)

FACT_ORDER = _table(
    order_id=StringType(),
    user_id=LongType(),
    product_id=LongType(),
    discount_id=LongType(),
    time_id=IntegerType(),
    vendor_id=LongType(),
    quantity=IntegerType(),
    gross_amount=_MONEY,
    discount_amount=_MONEY,
    net_amount=_MONEY,
    payment_method=StringType(),
    purchase_channel=StringType(),
    order_status=StringType(),
    province=StringType(),
    city=StringType(),
    order_date=DateType(),
)

FACT_EVENT = _table(
    event_id=StringType(),
    user_id=LongType(),
    product_id=LongType(),
    session_id=StringType(),
    event_type=StringType(),
    event_ts=TimestampType(),
    event_date=DateType(),
)

USER_BEHAVIOR_PROFILE = _table(
    user_id=LongType(),
    avg_research_time=IntegerType(),
    decision_time=IntegerType(),
    purchase_intensity=_SHORT_SHARE,
    preferred_category=StringType(),
    channel_preference=ArrayType(StringType()),
    social_influence_factor=_SHORT_SHARE,
)

COUPON_STRATEGY = _table(
    strategy_id=LongType(),
    min_discount_sensitivity=_SHORT_SHARE,
    min_view_count=IntegerType(),
    min_cart_count=IntegerType(),
    trigger_type=StringType(),
    action_type=StringType(),
    coupon_id=LongType(),
)

USER_CREDIT_SCORE = _table(
    user_id=LongType(),
    is_high_risk=DoubleType(),
    risk_score=FloatType(),
    scoring_date=DateType(),
)

VENDOR_PERFORMANCE_SCORE = _table(
    vendor_id=LongType(),
    vendor_name=StringType(),
    performance_score=DoubleType(),
    scoring_date=DateType(),
)


@dataclass(frozen=True)
class TableSpec:
    """Schema plus physical layout of one table."""

    schema: StructType
    file_format: str = "orc"
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[int, str] | None = None
    char_columns: tuple[tuple[str, int], ...] = ()

    def ddl_type(self, column: str) -> str:
        """Type of ``column`` in a CREATE TABLE; CHAR exists only there."""
        for name, length in self.char_columns:
            if name == column:
                return CharType(length).simpleString()
        return self.schema[column].dataType.simpleString()


# File format, partition columns and buckets of each table.
TABLES: dict[str, TableSpec] = {
    "dim_user": TableSpec(
        DIM_USER, partition_by=("country",), bucket_by=(32, "user_id"), char_columns=(("gender", 1),)
    ),
    "dim_product": TableSpec(DIM_PRODUCT, bucket_by=(16, "product_id")),
    "dim_vendor": TableSpec(DIM_VENDOR, partition_by=("country",)),
    "dim_discount": TableSpec(DIM_DISCOUNT),
    "dim_time": TableSpec(DIM_TIME, file_format="parquet"),
    "fact_order": TableSpec(FACT_ORDER, partition_by=("order_date",), bucket_by=(64, "user_id")),
    "fact_event": TableSpec(FACT_EVENT, partition_by=("event_date",)),
    "user_behavior_profile": TableSpec(USER_BEHAVIOR_PROFILE, file_format="parquet"),
    "coupon_strategy": TableSpec(COUPON_STRATEGY),
    "user_credit_score": TableSpec(USER_CREDIT_SCORE),
    "vendor_performance_score": TableSpec(VENDOR_PERFORMANCE_SCORE),
}
