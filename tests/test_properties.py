"""Relations that hold on any data, checked on random orders and on the test tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlight.operators import bi, features, rules
from martlight.plans.registry import all_queries
from martlight.sources.testdata import RATING_DATE, SNAPSHOT_DATE, TestdataWarehouse
from tests import builders as b

purchases = st.lists(
    st.tuples(st.integers(1, 4), st.dates(dt.date(2025, 1, 1), dt.date(2025, 2, 15))), min_size=0, max_size=25
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(purchases)
def test_repurchase_cycle_is_the_mean_of_all_gaps(spark, bought):
    orders = b.orders(spark, [{"user_id": u, "order_date": d} for u, d in bought])
    days = {u: sorted({d for v, d in bought if v == u}) for u, _ in bought}
    gaps = [(later - earlier).days for ds in days.values() for earlier, later in zip(ds, ds[1:])]
    expected = round(sum(gaps) / len(gaps) + 1e-12, 2) if gaps else None
    assert bi.repurchase_cycle_days(orders).first()[0] == expected
    assert sorted(r.gap_days for r in bi.repurchase_gaps(orders).collect()) == sorted(gaps)


@pytest.fixture(scope="module")
def w(spark, sf_dir):
    return TestdataWarehouse(spark, sf_dir)


def test_ratings_partition_the_active_users(w):
    orders = w.table("fact_order", "user_id", "order_date", "order_status", "net_amount")
    rated = bi.user_credit_rating(orders, w.table("dim_user", "user_id", "registration_date"), RATING_DATE)
    active = orders.where(F.col("order_date") > F.date_sub(F.lit(RATING_DATE).cast("date"), 90))
    assert rated.count() == rated.select("user_id").distinct().count() == active.select("user_id").distinct().count()


def test_one_feature_row_per_user_also_when_few_have_orders(w):
    recent = w.table("fact_order").where("order_date >= '2001-07-01'")
    users = w.table("dim_user")
    found = features.user_risk_features(recent, users, SNAPSHOT_DATE)
    assert found.count() == users.count()
    assert found.where("recency = 999").count() > 0
    assert found.where("(recency = 999) != (frequency = 0)").count() == 0


def test_net_amount_is_never_negative_and_every_purchase_becomes_an_order(w, spark, sf_dir):
    orders = all_queries()["orders_from_events"](spark, sf_dir)
    totals = orders.agg(F.count(F.lit(1)), F.min("net_amount"), F.count_distinct("order_id")).first()
    purchases = w.table("fact_event", "event_type", "product_id").where("event_type = 'purchase'")
    known = purchases.join(w.table("dim_product", "product_id"), "product_id").count()
    assert totals[0] == totals[2] == known and totals[1] >= 0


def test_calendar_has_every_day_once(w):
    days = rules.build_dim_time(w.table("fact_order", "order_date")).agg(
        F.count(F.lit(1)), F.count_distinct("time_id"), F.datediff(F.max("dt"), F.min("dt")) + 1
    )
    rows, distinct, span = days.first()
    assert rows == distinct == span


def test_results_do_not_depend_on_partitioning(w, spark):
    columns = ("user_id", "order_date", "order_id", "net_amount", "discount_amount", "order_status", "payment_method")
    orders, users = w.table("fact_order", *columns), w.table("dim_user", "user_id", "registration_date", "credit_score")
    one = features.user_risk_labels(orders, users, SNAPSHOT_DATE)
    other = features.user_risk_labels(orders.repartition(13), users.repartition(3), SNAPSHOT_DATE)
    assert sorted(map(tuple, one.collect()), key=lambda r: r[0]) == sorted(map(tuple, other.collect()), key=lambda r: r[0])
