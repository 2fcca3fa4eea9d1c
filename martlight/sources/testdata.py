"""The driver's TPC-H-like parquet tables seen as warehouse tables.

Each warehouse column is a fixed SQL expression over the test tables. A table is
built from just the test tables its requested columns need: look-ups are left
joins on a unique key, so leaving one out changes no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from martlight.schemas import COUPON_STRATEGY, TABLES

# Dates the test queries are asked as of.
RATING_DATE = "2001-08-01"
SNAPSHOT_DATE = "2001-08-02"
SCORES_AS_OF = "2024-02-05"
EVENTS_AS_OF = "2024-01-28 12:00:00"
QUARTER = ("1997-04-01", "1997-06-30")
DEMAND_SINCE = "1997-01-01"
LAYOUT_MONTH = ("1997-04-01", "1997-04-30")
CHANGED_DAYS = ("1997-04-09", "1997-04-10", "1997-06-03")
LAYOUT_WEEK = ("1997-04-08", "1997-04-14")
DISCOUNT_COUNT = 10


def _raw(columns: str) -> StructType:
    kinds = {
        "int": IntegerType(),
        "bigint": LongType(),
        "double": DoubleType(),
        "string": StringType(),
        "timestamp_ntz": TimestampNTZType(),
    }
    pairs = [column.split() for column in columns.split(", ")]
    return StructType([StructField(name, kinds[kind]) for name, kind in pairs])


# Schemas of the test tables used.
RAW_TABLES = {
    "region": _raw("r_regionkey int, r_name string"),
    "nation": _raw("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _raw("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": _raw("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _raw(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": _raw(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _raw(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": _raw(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

_GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISCOUNT = f"CAST({_GROSS} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2))"
_CHANNELS = "array('web', 'mobile_app', 'mini_program', 'social_media', 'affiliate')"

_ORDER_COLUMNS = {
    "order_id": "concat_ws('-', l_orderkey, l_linenumber)",
    "user_id": "o_custkey",
    "product_id": "l_partkey",
    "discount_id": "CASE WHEN l_discount <> 0 THEN CAST(round(l_discount * 100) AS BIGINT) END",
    "time_id": "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)",
    "vendor_id": "l_suppkey",
    "quantity": "CAST(l_quantity AS INT)",
    "gross_amount": _GROSS,
    "discount_amount": _DISCOUNT,
    "net_amount": f"CAST({_GROSS} - {_DISCOUNT} AS DECIMAL(12,2))",
    "payment_method": """CASE o_orderpriority
        WHEN '1-URGENT' THEN 'prepaid_card' WHEN '2-HIGH' THEN 'credit_card'
        WHEN '3-MEDIUM' THEN 'third_party' WHEN '4-NOT SPECIFIED' THEN 'unionpay'
        WHEN '5-LOW' THEN 'wire_transfer' END""",
    "purchase_channel": f"{_CHANNELS}[l_linenumber % 5]",
    "order_status": """CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN o_orderstatus = 'F' THEN 'Completed'
        WHEN o_orderstatus = 'O' THEN 'Shipped' WHEN o_orderstatus = 'P' THEN 'Pending' END""",
    "province": "n_name",
    "city": "c_mktsegment",
    "order_date": "CAST(o_orderdate AS DATE)",
}
_ADDRESS = {"province", "city"}
_FROM_ORDERS = {"user_id", "time_id", "payment_method", "order_status", "order_date"} | _ADDRESS

_REGISTERED = "date_sub(DATE '1995-01-01', CAST(c_custkey * 37 % 700 AS INT))"
_USER_COLUMNS = {
    "user_id": "c_custkey",
    "user_name": "c_name",
    "gender": "array('M', 'F', 'O')[CAST(c_custkey % 3 AS INT)]",
    "age": "CAST(18 + c_custkey % 48 AS SMALLINT)",
    "email": "concat('user', c_custkey, '@example.com')",
    "phone": "lpad(CAST(c_custkey AS STRING), 11, '0')",
    "province": "n_name",
    "city": "c_mktsegment",
    "registration_date": _REGISTERED,
    "last_login": f"CAST(date_add({_REGISTERED}, CAST(c_custkey % 30 AS INT)) AS TIMESTAMP)",
    "vip_level": "CAST(c_custkey % 6 AS TINYINT)",
    "discount_sensitivity": "CAST(CAST(c_custkey * 13 % 70 AS DECIMAL(10,0)) / 100 AS DECIMAL(5,4))",
    "return_rate": "CAST(CAST(c_custkey % 31 AS DECIMAL(10,0)) / 100 AS DECIMAL(5,4))",
    "credit_score": "CAST(300 + floor((c_acctbal + 1000) / 20) AS INT)",
    "country": "r_name",
}

_PRODUCT_COLUMNS = {
    "product_id": "p_partkey",
    "category": "concat(p_type, '>', p_brand)",
    "brand": "p_brand",
    "unit_price": "CAST(p_retailprice AS DECIMAL(10,2))",
    "stock": "p_size",
    "description": "concat('A ', p_name, ', by \"', p_brand, '\"')",
    "implicit_attributes": """to_json(named_struct(
        'color', get(split(p_name, ' '), 0), 'size', get(split(p_name, ' '), 1)))""",
    "vendor_id": "first_supplier",
}

_COST = "CAST(500 + s_suppkey * 13 % 300 AS DECIMAL(10,2))"
_VENDOR_COLUMNS = {
    "vendor_id": "s_suppkey",
    "vendor_name": "s_name",
    "cost_price": _COST,
    "market_price": f"CAST({_COST} * 1.15 AS DECIMAL(10,2))",
    "vendor_rating": "CAST(1 + CAST(s_suppkey * 7 % 41 AS DECIMAL(10,0)) / 10 AS DECIMAL(3,2))",
    "service_quality": "CAST(2.5 + CAST(s_suppkey % 26 AS DECIMAL(10,0)) / 10 AS DECIMAL(3,2))",
    "avg_delivery_time": "CAST(1 + s_suppkey % 8 AS INT)",
    "vendor_return_rate": "CAST(CAST(s_suppkey % 20 AS DECIMAL(10,0)) / 100 AS DECIMAL(5,4))",
    "distribution_areas": "slice(array('East', 'South', 'North'), 1, CAST(1 + s_suppkey % 3 AS INT))",
    "country": "r_name",
}

_KIND = "array('percentage', 'fixed', 'coupon')[CAST(id % 3 AS INT)]"
_VALID_FROM = "date_add(DATE '2024-01-01', CAST(2 * id AS INT))"
_DISCOUNT_COLUMNS = {
    "discount_id": "id",
    "discount_name": f"concat('D_', upper({_KIND}), '_', id)",
    "discount_type": _KIND,
    "threshold_amount": "CAST(array(0, 100, 200, 500)[CAST(id % 4 AS INT)] AS DECIMAL(12,2))",
    "discount_value": """CASE WHEN id % 3 = 0 THEN CAST(CAST(id AS DECIMAL(10,0)) / 100 AS DECIMAL(10,2))
        ELSE CAST(5 + 4 * id AS DECIMAL(10,2)) END""",
    "valid_from": f"CAST({_VALID_FROM} AS TIMESTAMP)",
    "valid_to": f"CAST(date_add({_VALID_FROM}, 7) AS TIMESTAMP)",
}

_EVENT_COLUMNS = {
    "event_id": "CAST(event_id AS STRING)",
    "user_id": "user_id",
    "product_id": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "session_id": "concat_ws('-', user_id, date_format(ts, 'yyyyMMdd'))",
    "event_type": "CASE event_type WHEN 'click' THEN 'cart_add' ELSE event_type END",
    "event_ts": "CAST(ts AS TIMESTAMP)",
    "event_date": "CAST(ts AS DATE)",
    # Purchase details; not columns of the stored event table.
    "quantity": "CAST(1 + event_id % 5 AS INT)",
    "payment_method": """array('credit_card', 'third_party', 'unionpay', 'prepaid_card')
        [CAST(event_id % 4 AS INT)]""",
    "purchase_channel": f"{_CHANNELS}[CAST(event_id % 5 AS INT)]",
}

_EXPRESSIONS = {
    "dim_user": _USER_COLUMNS,
    "dim_product": _PRODUCT_COLUMNS,
    "dim_vendor": _VENDOR_COLUMNS,
    "dim_discount": _DISCOUNT_COLUMNS,
    "fact_order": _ORDER_COLUMNS,
    "fact_event": _EVENT_COLUMNS,
}


def _project(df: DataFrame, name: str, columns: tuple[str, ...]) -> DataFrame:
    return df.selectExpr(*[f"{_EXPRESSIONS[name][c]} AS {c}" for c in columns])


def as_fact_event(raw_events: DataFrame, *columns: str) -> DataFrame:
    """Shop events among the raw events; works on a batch and on a stream."""
    shop = raw_events.where(F.col("event_type").isin("view", "click", "purchase"))
    return _project(shop, "fact_event", columns or tuple(TABLES["fact_event"].schema.fieldNames()))


class TestdataWarehouse:
    """Warehouse tables over one folder of test tables; same look-up as ``Warehouse``."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str, *columns: str) -> DataFrame:
        """A warehouse table, or just ``columns`` of it."""
        wanted = columns or tuple(TABLES[name].schema.fieldNames())
        if name == "fact_event":
            return as_fact_event(self.raw("events"), *wanted)
        build = {
            "dim_user": self._users,
            "dim_product": self._products,
            "dim_vendor": self._vendors,
            "dim_discount": self._discounts,
            "fact_order": self._orders,
        }[name]
        return _project(build(set(wanted)), name, wanted)

    def _with_region(self, df: DataFrame, nation_key: str, wanted: set[str]) -> DataFrame:
        if wanted & {"province", "country"}:
            nations = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
            df = df.join(nations, F.col(nation_key) == F.col("n_nationkey"), "left")
        if "country" in wanted:
            df = df.join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return df

    def _users(self, wanted: set[str]) -> DataFrame:
        return self._with_region(self.raw("customer"), "c_nationkey", wanted)

    def _vendors(self, wanted: set[str]) -> DataFrame:
        return self._with_region(self.raw("supplier"), "s_nationkey", wanted)

    def _products(self, wanted: set[str]) -> DataFrame:
        parts = self.raw("part")
        if "vendor_id" in wanted:
            suppliers = self.raw("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("first_supplier"))
            parts = parts.join(suppliers, F.col("p_partkey") == F.col("l_partkey"), "left")
        return parts

    def _discounts(self, wanted: set[str]) -> DataFrame:
        return self.spark.range(1, DISCOUNT_COUNT + 1)

    def _orders(self, wanted: set[str]) -> DataFrame:
        lines = self.raw("lineitem")
        if not wanted & _FROM_ORDERS:
            return lines
        orders = self.raw("orders")
        if wanted & _ADDRESS:
            # The address joins the narrower orders, not their lines.
            homes = self._with_region(self.raw("customer"), "c_nationkey", wanted & _ADDRESS)
            orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def coupon_strategies(spark: SparkSession) -> DataFrame:
    """Three strategies of rising strictness."""
    rows = spark.sql(
        f"""SELECT * FROM VALUES
            (1, 0.10, 5, 5, 'view', 'popup', 1),
            (2, 0.30, 10, 10, 'cart_add', 'push', 2),
            (3, 0.50, 12, 12, 'cart_add', 'sms', 3)
            AS strategies({", ".join(COUPON_STRATEGY.fieldNames())})"""
    )
    return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in COUPON_STRATEGY])
