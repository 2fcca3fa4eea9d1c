"""Daily partial sums: equal to the whole reports, and only replaced days are read again."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martlight.operators import bi
from martlight.plans.daily_reports import DailyReports, day_partials, loaded_days
from martlight.session import shared_dir
from martlight.sources.ledger import LoadLedger
from tests import builders as b
from tests.test_order_stream import _metrics

DAYS = [f"2025-01-{d:02d}" for d in range(1, 11)]


def order_rows(rng, days, factor=1):
    return [
        {"order_id": f"{d}-{i}", "user_id": 1, "product_id": rng.randrange(6), "vendor_id": 1, "time_id": 1, "quantity": rng.randrange(1, 5),
         "gross_amount": 9, "discount_amount": 0, "net_amount": factor * rng.randrange(100), "payment_method": "credit_card",
         "purchase_channel": "web", "province": f"p{rng.randrange(2)}", "city": f"c{rng.randrange(3)}", "order_date": d}
        for d in days
        for i in range(rng.randrange(1, 30))
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reports_follow_the_loads(spark):
    rng = random.Random(1)
    base = shared_dir(spark, "daily")
    ledger, reports = LoadLedger(spark, f"{base}/warehouse"), DailyReports(spark, f"{base}/reports")
    products = b.products(spark, [{"product_id": i, "category": f"m{i % 3}>s"} for i in range(6)])
    assert reports.warehouse_demand_top(DAYS[0]).isEmpty()
    for load_id, days, factor in (("a", DAYS, 1), ("b", DAYS[3:5], 7), ("c", DAYS[9:] + ["2025-01-20"], 2)):
        record = ledger.load(b.orders(spark, order_rows(rng, days, factor)), "fact_order", load_id)
        assert loaded_days(record) == [dt.date.fromisoformat(d) for d in days]
        orders = ledger.table("fact_order")
        for _ in range(2):
            reports.refresh(orders, loaded_days(record))
        for start, end in ((DAYS[0], "2025-01-31"), (DAYS[3], DAYS[4]), (DAYS[2], DAYS[2])):
            whole = bi.category_sales_share(orders, products, start, end)
            assert rows_of(reports.category_sales_share(products, start, end)) == rows_of(whole)
            assert rows_of(reports.warehouse_demand_top(start, 4)) == rows_of(bi.warehouse_demand_top(orders, start, 4))


def test_a_day_without_orders_loses_its_partials(spark):
    reports = DailyReports(spark, shared_dir(spark, "daily"))
    orders = b.orders(spark, order_rows(random.Random(2), DAYS[:3]))
    days = [dt.date.fromisoformat(d) for d in DAYS[:3]]
    reports.refresh(orders, days)
    reports.refresh(orders.where(F.col("order_date") != days[1]), days[1:2])
    assert {r.order_date for r in reports.partials("city_demand").collect()} == {days[0], days[2]}
    reports.refresh(orders, [])


def test_only_replaced_days_are_read(spark):
    base = shared_dir(spark, "daily")
    ledger = LoadLedger(spark, base)
    ledger.load(b.orders(spark, order_rows(random.Random(3), DAYS)), "fact_order", "a")
    asked = [dt.date.fromisoformat(d) for d in DAYS[3:5]]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        partials = day_partials(ledger.table("fact_order"), "product_sales", asked)
        assert [m["numPartitions"] for m in _metrics(spark, partials, "product_id")] == [2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
