"""Shape of the physical plans: what reaches the scan, what is shuffled, how a hot key is treated."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from martlight.operators import behavior, rules
from tests import builders as b

LAZY = [
    "category_sales_share",
    "repurchase_cycle_days",
    "coupon_roi",
    "vendor_value_top10",
    "warehouse_demand_top20",
    "user_credit_rating",
    "user_risk_label",
    "user_risk_label_v1",
    "vendor_features",
    "build_dim_time",
    "best_valid_discount",
    "best_valid_discount_by_day",
    "orders_from_events",
    "session_funnel",
    "user_behavior_profile",
    "coupon_targeting",
    "coupon_targeting_by_level",
    "not_null_audit",
    "check_audit",
    "table_profile",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_worker_no_cross_join_no_global_window(spark, sf_dir, name):
    plan = _plan(queries()[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert all(re.search(r"windowspecdefinition\((stretch|level)", w) for w in windows)


@pytest.mark.parametrize("name", ["category_sales_share", "warehouse_demand_top20", "user_credit_rating"])
def test_date_filter_reaches_the_scan(spark, sf_dir, name):
    plan = _plan(queries()[name](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^]]*o_orderdate", plan)


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = _plan(queries()["coupon_roi"](spark, sf_dir))
    assert "orders.parquet" not in plan and "customer.parquet" not in plan
    assert "l_partkey" not in plan and "l_suppkey" not in plan


@pytest.mark.parametrize("name", ["vendor_value_top10", "warehouse_demand_top20", "top_risk_users", "top_vendors_by_score"])
def test_top_k_does_not_sort_everything(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in _plan(queries()[name](spark, sf_dir))


def test_rules_that_last_are_not_repeated_by_stretch(spark):
    """300 rules over 200 stretches: each steps in and out once; stretches between get only what could be chosen."""
    rules_ = [
        {"discount_id": i, "discount_type": "fixed", "threshold_amount": i % 50, "discount_value": i % 40 + 1,
         "valid_from": "2025-01-01 00:00:00", "valid_to": f"2025-01-{2 + i % 9:02d} 12:30:00"}
        for i in range(300)
    ]
    hour = 3600 * 10**6
    start = 1735689600 * 10**6
    steps = rules.discount_steps(b.discounts(spark, rules_), rules._Stretches([start + hour * i for i in range(1, 240)])).collect()
    assert all(len(r["values"]) <= 50 for r in steps)
    # One step at the start of a stretch, one for each of the ten distinct ends.
    assert 200 < len(steps) <= 240 + 10


def test_orders_are_counted_before_they_meet_the_products(spark):
    """A third of all orders on one product: only counts by user, product and channel are shuffled."""
    n = 60_000
    product = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    orders = spark.range(0, n, 1, 8).select(
        (F.col("id") % 501).alias("user_id"), product.alias("product_id"), F.lit("web").alias("purchase_channel")
    )
    products = spark.range(997).select(
        F.col("id").alias("product_id"), F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("category")
    )
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        profile = behavior.user_behavior_profile(b.events(spark, []), orders, products)
        plan = _plan(profile)
        rows = profile.collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert re.search(r"Exchange hashpartitioning\(product_id[^\n]*\n[^\n]*HashAggregate\(keys=\[user_id", plan)
    assert len(rows) == 501
    assert all(r.channel_preference == ["web"] for r in rows)
