from martlight.operators import features
from martlight.operators.features import CURRENT_RULES, EARLIER_RULES
from tests import builders as b

AS_OF = "2025-07-01"


def test_users_without_orders_are_kept_and_filled(spark):
    users = b.users(
        spark,
        [
            {"user_id": 1, "registration_date": "2025-06-01", "credit_score": 700},
            {"user_id": 2, "registration_date": None, "credit_score": None},
        ],
    )
    orders = b.orders(
        spark,
        [
            {"user_id": 1, "order_date": "2025-06-21", "net_amount": 10, "discount_amount": 1, "order_status": "Returned"},
            {"user_id": 1, "order_date": "2025-06-11", "net_amount": 20, "discount_amount": 2, "payment_method": "prepaid_card"},
            {"user_id": 3, "order_date": "2025-06-11", "net_amount": 20},
        ],
    )
    found = b.as_dict(features.user_risk_features(orders, users, AS_OF), "user_id")
    assert set(found) == {1, 2}
    one, two = found[1], found[2]
    assert (one["frequency"], float(one["monetary"]), float(one["avg_discount"])) == (2, 30.0, 1.5)
    assert (one["return_rate_model"], one["prepaid_card_count"]) == (0.5, 1)
    assert (one["recency"], one["user_tenure"]) == (10, 30)
    assert (two["frequency"], float(two["monetary"]), two["recency"]) == (0, 0.0, 999)
    assert two["user_tenure"] is None and two["last_purchase_date"] is None

    earlier = b.as_dict(features.user_risk_labels_v1(orders, users, AS_OF), "user_id")
    assert set(earlier) == {1}


def test_label_rules_are_strict_and_first_match_wins(spark):
    schema = "return_rate_model double, prepaid_card_count bigint, credit_score int, recency int, monetary decimal(12,2)"
    rows = [
        ((0.6, 5, 700, 50, 0), 0.0),
        ((0.61, 1, 700, 50, 0), 0.0),
        ((0.61, 2, 700, 50, 0), 1.0),
        ((0.0, 0, 400, 50, 0), 0.0),
        ((0.0, 0, 399, 50, 0), 1.0),
        ((0.0, 0, None, 50, 0), 0.0),
        ((0.0, 0, None, 9, 5001), 1.0),
        ((0.0, 0, 700, 10, 9000), 0.0),
        ((0.0, 0, 700, 9, 5000), 0.0),
    ]
    from decimal import Decimal

    data = [(*r[:4], Decimal(r[4])) for r, _ in rows]
    labelled = spark.createDataFrame(data, schema).coalesce(1).select(CURRENT_RULES.label().alias("y"))
    assert [r.y for r in labelled.collect()] == [y for _, y in rows]

    earlier = [((0.5, 1, 700, 1, 0), 0.0), ((0.51, 1, 700, 1, 0), 1.0), ((0, 0, 450, 1, 0), 0.0), ((0, 0, 449, 1, 0), 1.0)]
    data = [(float(r[0]), *r[1:4], Decimal(r[4])) for r, _ in earlier]
    labelled = spark.createDataFrame(data, schema).coalesce(1).select(EARLIER_RULES.label().alias("y"))
    assert [r.y for r in labelled.collect()] == [y for _, y in earlier]


def test_earlier_variant_fills_every_number_after_labelling(spark):
    users = b.users(spark, [{"user_id": 1, "registration_date": None, "credit_score": None, "vip_level": None}])
    orders = b.orders(spark, [{"user_id": 1, "order_date": "2025-06-21", "net_amount": 10}])
    row = features.user_risk_labels_v1(orders, users, AS_OF).first()
    assert (row.label, row.credit_score, row.vip_level, row.user_tenure) == (0.0, 0, 0, 0)
    assert row.registration_date is None


def test_vendor_features_fill_and_zero_cost(spark):
    vendors = b.vendors(
        spark,
        [
            {"vendor_id": 1, "cost_price": 10, "vendor_name": "a"},
            {"vendor_id": 2, "cost_price": 0, "vendor_name": "b"},
            {"vendor_id": 3, "cost_price": 10, "vendor_name": "c", "vendor_rating": None},
        ],
    )
    products = b.products(
        spark,
        [
            {"product_id": 1, "vendor_id": 1, "unit_price": 15},
            {"product_id": 2, "vendor_id": 1, "unit_price": 25},
            {"product_id": 3, "vendor_id": 1, "unit_price": None},
            {"product_id": 4, "vendor_id": 2, "unit_price": 25},
        ],
    )
    orders = b.orders(
        spark,
        [
            {"vendor_id": 1, "net_amount": 5, "order_status": "Returned"},
            {"vendor_id": 1, "net_amount": 6},
        ],
    )
    margin = b.as_dict(features.vendor_profit_margin(products, vendors), "vendor_id")
    assert margin[1]["avg_profit_margin"] == 1.0
    assert margin[2]["avg_profit_margin"] is None
    assert set(margin) == {1, 2}

    found = b.as_dict(features.vendor_features(orders, products, vendors), "vendor_id")
    assert [found[v]["avg_profit_margin"] for v in (1, 2, 3)] == [1.0, 0.0, 0.0]
    assert [found[v]["sales_volume"] for v in (1, 2, 3)] == [2, 0, 0]
    assert found[1]["order_return_rate"] == 0.5
    assert float(found[3]["vendor_rating"]) == 0.0
    assert found[3]["distribution_areas"] is None

    labels = b.as_dict(
        features.vendor_performance_labels(features.vendor_features(orders, products, vendors)), "vendor_id"
    )
    assert abs(labels[1]["performance_label"] - (1.6 + 0.3 + 0.1 + 0.05)) < 1e-12
    assert abs(labels[2]["performance_label"] - (1.6 + 0.2 + 0.05)) < 1e-12
