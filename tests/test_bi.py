from martlight.operators import bi
from tests import builders as b


def test_category_share_closed_range_and_odd_categories(spark):
    products = b.products(
        spark,
        [
            {"product_id": 1, "category": "A>x"},
            {"product_id": 2, "category": "A"},
            {"product_id": 3, "category": None},
        ],
    )
    orders = b.orders(
        spark,
        [
            {"product_id": 1, "order_date": "2025-04-01", "net_amount": 30},
            {"product_id": 2, "order_date": "2025-06-30", "net_amount": 30},
            {"product_id": 3, "order_date": "2025-05-01", "net_amount": 60},
            {"product_id": 1, "order_date": "2025-03-31", "net_amount": 1000},
            {"product_id": 1, "order_date": "2025-07-01", "net_amount": 1000},
            {"product_id": 9, "order_date": "2025-05-01", "net_amount": 1000},
        ],
    )
    rows = bi.category_sales_share(orders, products, "2025-04-01", "2025-06-30").collect()
    assert {(r.main_category, float(r.total_sales), r.sales_percentage) for r in rows} == {
        ("A", 60.0, 50.0),
        (None, 60.0, 50.0),
    }


def test_category_share_adds_up_to_100(spark, sf_dir):
    from __spark_entry__ import queries

    rows = queries()["category_sales_share"](spark, sf_dir).collect()
    assert abs(sum(r.sales_percentage for r in rows) - 100) < 0.01 * len(rows)
    assert [r.total_sales for r in rows] == sorted((r.total_sales for r in rows), reverse=True)


def test_category_share_of_no_sales_is_empty(spark):
    empty = bi.category_sales_share(b.orders(spark, []), b.products(spark, []), "2025-01-01", "2025-02-01")
    assert empty.collect() == []


def test_repurchase_cycle_counts_distinct_days_of_repeat_buyers(spark):
    days = [(1, "2025-01-01"), (1, "2025-01-01"), (1, "2025-01-11"), (1, "2025-01-12"), (2, "2025-01-05"), (2, None)]
    orders = b.orders(spark, [{"user_id": u, "order_date": d} for u, d in days])
    assert bi.repurchase_cycle_days(orders).first()[0] == 5.5
    gaps = [r.gap_days for r in bi.repurchase_gaps(orders).orderBy("order_date").collect()]
    assert gaps == [10, 1]


def test_repurchase_cycle_without_repeat_buyers_is_null(spark):
    orders = b.orders(spark, [{"user_id": 1, "order_date": "2025-01-01"}])
    assert bi.repurchase_cycle_days(orders).collect()[0][0] is None


def test_coupon_roi_with_zero_cost_is_null_and_last(spark):
    discounts = b.discounts(
        spark,
        [
            {"discount_id": 1, "discount_name": "free", "discount_type": "fixed"},
            {"discount_id": 2, "discount_name": "paid", "discount_type": "coupon"},
            {"discount_id": 3, "discount_name": "paid", "discount_type": "coupon"},
        ],
    )
    orders = b.orders(
        spark,
        [
            {"discount_id": 1, "net_amount": 10, "discount_amount": 0},
            {"discount_id": 2, "net_amount": 90, "discount_amount": 10},
            {"discount_id": 3, "net_amount": 110, "discount_amount": 30},
            {"discount_id": None, "net_amount": 5, "discount_amount": 5},
        ],
    )
    rows = [tuple(r) for r in bi.coupon_roi(orders, discounts).collect()]
    assert [(r[0], r[2], float(r[3]), float(r[4]), r[5]) for r in rows] == [
        ("paid", 2, 200.0, 40.0, 4.0),
        ("free", 1, 10.0, 0.0, None),
    ]


def test_vendor_value_with_zero_cost_has_no_score(spark):
    vendors = b.vendors(
        spark,
        [
            {"vendor_id": 1, "vendor_name": "zero", "cost_price": 0},
            {"vendor_id": 2, "vendor_name": "some", "cost_price": 10},
            {"vendor_id": 3, "vendor_name": "idle", "cost_price": 10},
        ],
    )
    orders = b.orders(
        spark,
        [
            {"vendor_id": 1, "quantity": 1, "gross_amount": 50},
            {"vendor_id": 2, "quantity": 2, "gross_amount": 15},
            {"vendor_id": 2, "quantity": 1, "gross_amount": 15},
        ],
    )
    rows = bi.vendor_value_top(orders, vendors).collect()
    assert [(r.vendor_id, r.value_score) for r in rows] == [(2, 1.38), (1, None)]
    assert float(rows[0].total_cost) == 30.0


def test_demand_is_bounded_below_and_ties_break_by_place(spark):
    rows = [
        {"province": "P", "city": "b", "order_date": "2025-01-01", "net_amount": 5},
        {"province": "P", "city": "a", "order_date": "2025-01-02", "net_amount": 5},
        {"province": "P", "city": "c", "order_date": "2024-12-31", "net_amount": 99},
    ]
    top = bi.warehouse_demand_top(b.orders(spark, rows), "2025-01-01", 20).collect()
    assert [(r.city, r.total_orders, r.total_quantity) for r in top] == [("a", 1, 1), ("b", 1, 1)]


def test_credit_rating_strict_bounds(spark):
    as_of = "2025-07-01"
    registered = {"long": "2024-01-01", "180": "2025-01-02", "90": "2025-04-02", "91": "2025-04-01"}
    cases = {  # user: (registration, amounts, status, expected)
        1: ("long", [6000], "Completed", "High"),
        2: ("long", [5000], "Completed", "Medium"),
        3: ("180", [6000], "Completed", "Medium"),
        4: ("long", [500] * 11, "Completed", "Medium"),
        5: ("long", [1000], "Completed", "Standard"),
        6: ("90", [1500], "Completed", "Standard"),
        7: ("91", [1500], "Completed", "Medium"),
        8: ("long", [9000], "Returned", "Low"),
        9: ("long", [1], "Completed", "Standard"),
    }
    orders = [
        {"user_id": u, "order_date": "2025-06-30", "net_amount": a, "order_status": status}
        for u, (_, amounts, status, _) in cases.items()
        for a in amounts
    ]
    # Exactly 90 days back is outside the window; so is user 10 as a whole.
    orders += [{"user_id": u, "order_date": "2025-04-02", "net_amount": 9000} for u in (9, 10)]
    users = [{"user_id": u, "registration_date": registered[r]} for u, (r, *_) in cases.items()]
    users += [{"user_id": 10, "registration_date": "2024-01-01"}]
    rated = bi.user_credit_rating(b.orders(spark, orders), b.users(spark, users), as_of)
    assert {r.user_id: r.credit_rating for r in rated.collect()} == {u: c[3] for u, c in cases.items()}
    assert [r.user_id for r in rated.collect()][:1] == [8]
