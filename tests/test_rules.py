import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from martlight.operators import rules
from tests import builders as b


def test_calendar_days(spark):
    spans = spark.sql("SELECT DATE '2024-02-26' AS first_day, DATE '2024-03-03' AS last_day")
    days = b.as_dict(rules.calendar(spans), "time_id")
    assert sorted(days) == [20240226, 20240227, 20240228, 20240229, 20240301, 20240302, 20240303]
    monday, sunday = days[20240226], days[20240303]
    assert (monday["day_of_week"], monday["is_weekend"]) == (1, 0)
    assert (sunday["day_of_week"], sunday["is_weekend"]) == (7, 1)
    assert (sunday["year"], sunday["quarter"], sunday["month"], sunday["day"]) == (2024, 1, 3, 3)


def test_calendar_over_year_end_and_overlapping_spans(spark):
    spans = spark.sql(
        """SELECT * FROM VALUES (DATE '2024-12-30', DATE '2025-01-02'), (DATE '2025-01-01', DATE '2025-01-03')
           AS t(first_day, last_day)"""
    )
    assert rules.calendar(spans).count() == 5


def test_status_by_age_boundaries(spark):
    as_of = dt.datetime(2025, 7, 10, 12, 0, 0)
    day = dt.timedelta(days=1)
    ages = [-1 * day, 0 * day, day - dt.timedelta(seconds=1), day, 3 * day, 7 * day, 7 * day - dt.timedelta(seconds=1)]
    expected = ["Pending", "Processing", "Processing", "Shipped", "Delivered", "Completed", "Delivered"]
    rows = [(i, as_of - age, i == 5) for i, age in enumerate(ages)]
    df = spark.createDataFrame(rows, "id int, order_ts timestamp, returned boolean")
    found = rules.order_status_by_age(df, "2025-07-10 12:00:00").orderBy("id").collect()
    assert [r.order_status for r in found] == expected
    flagged = rules.order_status_by_age(df, "2025-07-10 12:00:00", returned_column="returned").orderBy("id").collect()
    assert [r.order_status for r in flagged] == [s if i != 5 else "Returned" for i, s in enumerate(expected)]


def test_vendor_rating_guards_zero_cost_and_caps_advantage(spark):
    vendors = b.vendors(
        spark,
        [
            {"vendor_id": 1, "cost_price": 0, "market_price": 10},
            {"vendor_id": 2, "cost_price": 10, "market_price": 100},
            {"vendor_id": 3, "cost_price": 10, "market_price": 11},
        ],
    )
    found = {r.vendor_id: r.vendor_rating for r in rules.rate_vendors(vendors).collect()}
    rest = 0.3 * 0.9 + 0.2 * 0.8 + 0.1 * 0.5
    assert found == {1: round(1 + 4 * rest, 2), 2: round(1 + 4 * (0.4 + rest), 2), 3: round(1 + 4 * (0.04 + rest), 2)}


DISCOUNTS = [
    {"discount_id": 1, "discount_type": "fixed", "threshold_amount": 100, "discount_value": 20,
     "valid_from": "2025-01-01 10:00:00", "valid_to": "2025-01-03 10:00:00"},
    {"discount_id": 2, "discount_type": "coupon", "threshold_amount": 0, "discount_value": 20,
     "valid_from": "2025-01-01 10:00:00", "valid_to": "2025-01-03 10:00:00"},
    {"discount_id": 3, "discount_type": "percentage", "threshold_amount": 200, "discount_value": "0.15",
     "valid_from": "2025-01-02 00:00:00", "valid_to": "9999-12-31 00:00:00"},
    {"discount_id": 4, "discount_type": "fixed", "threshold_amount": 0, "discount_value": 500,
     "valid_from": "2025-02-01 00:00:00", "valid_to": "2025-01-01 00:00:00"},
    {"discount_id": 5, "discount_type": "fixed", "threshold_amount": 0, "discount_value": 500,
     "valid_from": None, "valid_to": None},
]
PURCHASES = [
    ("at_start", "2025-01-01 10:00:00", "100.00", 1, "20.00"),
    ("before", "2025-01-01 09:59:59", "100.00", None, "0.00"),
    ("at_end", "2025-01-03 10:00:00", "99.99", 2, "20.00"),
    ("tie_lowest_id", "2025-01-01 12:00:00", "150.00", 1, "20.00"),
    ("percentage_wins", "2025-01-02 12:00:00", "200.30", 3, "30.05"),
    ("after", "2025-01-03 10:00:01", "50.00", None, "0.00"),
    ("much_later", "2026-01-03 10:00:01", "1000.00", 3, "150.00"),
    ("no_time", None, "100.00", None, "0.00"),
]


@pytest.mark.parametrize("purchases_each,ends_each", [(10**6, 10**6), (1, 1), (2, 10**6), (10**6, 2)])
def test_best_discount_edges(spark, purchases_each, ends_each):
    rows = [
        (e, dt.datetime.fromisoformat(ts) if ts else None, Decimal(g)) for e, ts, g, _, _ in PURCHASES
    ]
    purchases = spark.createDataFrame(rows, "event_id string, event_ts timestamp, gross_amount decimal(12,2)")
    found = b.as_dict(
        rules.best_valid_discount(purchases, b.discounts(spark, DISCOUNTS), purchases_each, ends_each), "event_id"
    )
    assert {e: (r["discount_id"], str(r["discount_amount"])) for e, r in found.items()} == {
        e: (d, a) for e, _, _, d, a in PURCHASES
    }


@pytest.mark.parametrize("purchases_each,ends_each", [(10**6, 10**6), (5, 3), (100, 10**6), (10**6, 1)])
def test_best_discount_against_brute_force(spark, purchases_each, ends_each):
    rng = random.Random(7)
    start = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(40):
        begin = start + dt.timedelta(hours=rng.randrange(0, 400))
        kind = rng.choice(["fixed", "coupon", "percentage"])
        rows.append(
            {"discount_id": i, "discount_type": kind, "threshold_amount": rng.choice([0, 100, 200, 500]),
             "discount_value": "0.9" if kind == "percentage" else rng.randrange(5, 50),
             "valid_from": str(begin), "valid_to": str(begin + dt.timedelta(hours=rng.randrange(1, 200)))}
        )
    # A third of the purchases fall on one day.
    purchases = [
        (f"e{i}",
         start + dt.timedelta(days=3, minutes=rng.randrange(1440)) if i % 3 == 0
         else start + dt.timedelta(minutes=rng.randrange(400 * 60)),
         Decimal(rng.randrange(100, 90000)) / 100)
        for i in range(600)
    ]

    def best(ts, gross):
        options = []
        for r in rows:
            if (dt.datetime.fromisoformat(r["valid_from"]) <= ts <= dt.datetime.fromisoformat(r["valid_to"])
                    and r["threshold_amount"] <= gross):
                value = Decimal(r["discount_value"])
                amount = gross * value if r["discount_type"] == "percentage" else value
                options.append((-amount, r["discount_id"]))
        if not options:
            return None, Decimal("0.00")
        amount, chosen = min(options)
        return chosen, (-amount).quantize(Decimal("0.01"), ROUND_HALF_UP)

    frame = spark.createDataFrame(purchases, "event_id string, event_ts timestamp, gross_amount decimal(12,2)")
    found = rules.best_valid_discount(frame, b.discounts(spark, rows), purchases_each, ends_each).collect()
    assert {r.event_id: (r.discount_id, r.discount_amount) for r in found} == {e: best(t, g) for e, t, g in purchases}
    assert len(found) == len(purchases)


def test_orders_from_events(spark):
    events = (
        b.events(
            spark,
            [
                {"event_id": "1", "user_id": 1, "product_id": 1, "event_type": "purchase", "event_ts": "2025-01-05 10:00:00"},
                {"event_id": "2", "user_id": 1, "product_id": 2, "event_type": "purchase", "event_ts": "2025-01-06 10:00:00"},
                {"event_id": "3", "user_id": 9, "product_id": 1, "event_type": "purchase", "event_ts": "2025-01-06 10:00:00"},
                {"event_id": "4", "user_id": 1, "product_id": 9, "event_type": "purchase", "event_ts": "2025-01-06 10:00:00"},
                {"event_id": "5", "user_id": 1, "product_id": 1, "event_type": "view", "event_ts": "2025-01-06 10:00:00"},
            ],
        )
        .withColumn("quantity", F.lit(3))
        .withColumn("payment_method", F.lit("credit_card"))
        .withColumn("purchase_channel", F.lit("web"))
    )
    products = b.products(
        spark, [{"product_id": 1, "unit_price": "9.99", "vendor_id": 7}, {"product_id": 2, "unit_price": 100, "vendor_id": 8}]
    )
    users = b.users(spark, [{"user_id": 1, "province": "P", "city": "C"}])
    discounts = b.discounts(
        spark,
        [{"discount_id": 4, "discount_type": "fixed", "threshold_amount": 0, "discount_value": 50,
          "valid_from": "2025-01-05 00:00:00", "valid_to": "2025-01-05 23:00:00"}],
    )
    orders = rules.orders_from_events(events, products, users, discounts, "2025-01-08 10:00:00")
    assert orders.columns == [f.name for f in b.schemas.FACT_ORDER]
    found = {r.product_id: r for r in orders.collect()}
    assert set(found) == {1, 2}
    # The discount exceeds the order: net stops at zero.
    assert (str(found[1].gross_amount), str(found[1].discount_amount), str(found[1].net_amount)) == ("29.97", "50.00", "0.00")
    assert (found[2].discount_id, str(found[2].net_amount), found[2].vendor_id) == (None, "300.00", 8)
    assert (found[1].order_status, found[2].order_status) == ("Delivered", "Shipped")
    assert (found[1].time_id, str(found[1].order_date), found[1].city) == (20250105, "2025-01-05", "C")
    assert len({r.order_id for r in found.values()}) == 2


def test_product_attributes_and_areas(spark):
    products = b.products(
        spark,
        [
            {"product_id": 1, "category": "服装>男装", "implicit_attributes": '{"color": "红", "size": "XL"}'},
            {"product_id": 2, "category": "家居", "implicit_attributes": '{"size": "M"}'},
            {"product_id": 3, "category": None, "implicit_attributes": None},
        ],
    )
    found = {r.product_id: tuple(r)[1:] for r in rules.product_attributes(products).collect()}
    assert found == {
        1: ("服装", "男装", "红", "XL"),
        2: ("家居", "家居", None, "M"),
        3: (None, None, None, None),
    }
    vendors = b.vendors(
        spark, [{"vendor_id": 1, "distribution_areas": ["华东", "华南"]}, {"vendor_id": 2, "distribution_areas": []}]
    )
    assert [tuple(r) for r in rules.vendor_areas(vendors).collect()] == [(1, "华东"), (1, "华南")]


def test_amounts_the_type_cannot_hold_become_null(spark):
    events = (
        b.events(
            spark,
            [{"event_id": "1", "user_id": 1, "product_id": 1, "event_type": "purchase", "event_ts": "2025-01-05 10:00:00"}],
        )
        .withColumn("quantity", F.lit(2_000_000_000))
        .withColumn("payment_method", F.lit("credit_card"))
        .withColumn("purchase_channel", F.lit("web"))
    )
    products = b.products(spark, [{"product_id": 1, "unit_price": "99999999.99", "vendor_id": 7}])
    users = b.users(spark, [{"user_id": 1}])
    row = rules.orders_from_events(events, products, users, b.discounts(spark, []), "2025-01-08 10:00:00").first()
    assert (row.gross_amount, row.net_amount, row.discount_id) == (None, None, None)


def test_many_overlapping_discounts_and_a_hot_day(spark):
    """5,000 rules, some open-ended; ids that repeat or are missing; every purchase comes out once."""
    import numpy as np

    rng = np.random.default_rng(5)
    start = int(dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    n, m = 5000, 3000
    lo = start + rng.integers(-20 * 86400, 40 * 86400, n)
    hi = np.where(rng.random(n) < 0.05, 253_402_214_400, lo + rng.integers(0, 20 * 86400, n))
    share = rng.random(n) < 0.3
    value = np.where(share, rng.integers(1, 60, n) / 100, rng.integers(1, 400, n))
    threshold = rng.integers(0, 900, n)
    rows = [
        (i, "percentage" if s else "fixed", Decimal(int(t)), Decimal(str(round(float(v), 2))), int(a), int(z))
        for i, (s, t, v, a, z) in enumerate(zip(share, threshold, value, lo, hi))
    ]
    discounts = spark.createDataFrame(
        rows, "discount_id long, discount_type string, threshold_amount decimal(12,2), discount_value decimal(10,2), a long, z long"
    ).selectExpr("*", "timestamp_seconds(a) AS valid_from", "timestamp_seconds(z) AS valid_to")
    ts = np.where(np.arange(m) % 3 == 0, start + 86400 * 7 + rng.integers(0, 86400, m), start + rng.integers(0, 30 * 86400, m))
    gross = rng.integers(100, 90_000, m)
    ids = [None if i % 7 == 0 else f"e{i % 11}" for i in range(m)]
    purchases = spark.createDataFrame(
        [(i, int(t), Decimal(int(g)) / 100) for i, t, g in zip(ids, ts, gross)], "event_id string, t long, gross_amount decimal(12,2)"
    ).selectExpr("event_id", "timestamp_seconds(t) AS event_ts", "gross_amount", "t")
    expected = Counter()
    cents = np.where(share[None, :], 0, np.round(value * 10_000)).astype(np.int64)
    percent = np.where(share, np.round(value * 100), 0).astype(np.int64)
    for i, t, g in zip(ids, ts.tolist(), gross.tolist()):
        usable = (lo <= t) & (t <= hi) & (threshold * 100 <= g)
        amount = np.where(usable, np.where(share, g * percent, cents[0]), -1)
        best = int(amount.argmax())
        expected[i, t, g, best if amount[best] >= 0 else None, max(0, int(amount[best]))] += 1
    for each in ((100_000, 200), (40, 50)):
        found = rules.best_valid_discount(purchases, discounts, *each)
        got = Counter(
            (r.event_id, r.t, int(r.gross_amount * 100), r.discount_id, int(r.exact_discount * 10_000)) for r in found.collect()
        )
        assert got == expected


def test_one_bad_clock_costs_no_rows(spark):
    """A purchase a hundred years ahead and an open-ended rule add one step, not an hour's row for a century."""
    discounts = b.discounts(
        spark,
        [{"discount_id": 1, "discount_type": "fixed", "threshold_amount": 0, "discount_value": 5,
          "valid_from": "2025-01-01 00:00:00", "valid_to": "9999-12-31 00:00:00"}],
    )
    times = ["2025-01-01 10:00:00", "2125-01-01 10:00:00", "2024-12-31 23:59:59", None]
    purchases = spark.createDataFrame([(t, Decimal(9)) for t in times], "t string, gross_amount decimal(12,2)").selectExpr(
        "t", "CAST(t AS TIMESTAMP) AS event_ts", "gross_amount"
    )
    assert rules.discount_steps(discounts, rules._Stretches([])).count() == 2
    found = {r.t: r.discount_id for r in rules.best_valid_discount(purchases, discounts, 1, 1).collect()}
    assert found == {times[0]: 1, times[1]: 1, times[2]: None, None: None}


def test_a_hot_instant_is_dealt_to_several_tasks(spark):
    """Half of all purchases at one microsecond: their stretch has as many keys as cuts fell on it."""
    now = int(dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    purchases = spark.range(4000).selectExpr(
        "id", f"timestamp_seconds({now} + IF(id % 2 = 0, 0, id)) AS event_ts", "CAST(id AS DECIMAL(12,2)) AS gross_amount"
    )
    cuts = rules._quantiles(purchases.select(F.unix_micros("event_ts").alias("at")), 100)
    assert len(cuts) == 39 and max(rules._Stretches(cuts).salts) >= 15
    discounts = b.discounts(
        spark,
        [{"discount_id": i, "discount_type": "fixed", "threshold_amount": i, "discount_value": i + 1,
          "valid_from": "2024-01-01 00:00:00", "valid_to": f"2026-01-0{1 + i % 3} 00:00:00"} for i in range(30)],
    )
    found = rules.best_valid_discount(purchases, discounts, 100, 7).collect()
    assert {r.id: r.discount_id for r in found} == {i: min(i, 29) for i in range(4000)} and len(found) == 4000
