import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from martlight import schemas
from martlight.operators import behavior
from tests import builders as b


def _event(session, kind, at, user=1):
    return {"event_id": f"{session}{kind}{at}", "user_id": user, "session_id": session, "event_type": kind,
            "event_ts": f"2025-01-01 10:00:{at:02d}"}


def test_funnel_counts_each_stage_with_all_before_it(spark):
    events = b.events(
        spark,
        [
            _event("a", "view", 1), _event("a", "cart_add", 2), _event("a", "purchase", 3),
            _event("b", "view", 1), _event("b", "view", 2),
            _event("c", "cart_add", 1), _event("c", "purchase", 1),
            _event("d", "view", 1), _event("d", "cart_add", 5),
        ],
    )
    row = behavior.session_funnel(events).first()
    assert tuple(row) == (4, 3, 2, 1, 0.6667, 0.5, 0.3333)


def test_funnel_of_nothing_has_no_rates(spark):
    assert tuple(behavior.session_funnel(b.events(spark, [])).first()) == (0, 0, 0, 0, None, None, None)


def test_profile(spark):
    events = b.events(
        spark,
        [
            _event("a", "view", 1), _event("a", "cart_add", 11), _event("a", "purchase", 31),
            _event("b", "view", 1), _event("b", "cart_add", 22),
            _event("c", "cart_add", 1), _event("c", "view", 9),
        ],
    )
    products = b.products(spark, [{"product_id": 1, "category": "B>x"}, {"product_id": 2, "category": "A>y"}])
    orders = b.orders(
        spark,
        [
            {"user_id": 1, "product_id": 1, "purchase_channel": "web"},
            {"user_id": 1, "product_id": 2, "purchase_channel": "affiliate"},
            {"user_id": 2, "product_id": 1, "purchase_channel": "web"},
            {"user_id": 2, "product_id": 1, "purchase_channel": None},
            {"user_id": 2, "product_id": 99, "purchase_channel": "social_media"},
        ],
    )
    found = b.as_dict(behavior.user_behavior_profile(events, orders, products), "user_id")
    one, two = found[1], found[2]
    # Sessions a and b: 10 and 21 seconds; c has its cart event first and does not count.
    assert (one["avg_research_time"], one["decision_time"]) == (16, 20)
    assert one["purchase_intensity"] == Decimal("0.14")
    assert (one["preferred_category"], one["channel_preference"]) == ("A", ["affiliate", "web"])
    assert one["social_influence_factor"] == Decimal("0.50")
    assert (two["avg_research_time"], two["preferred_category"]) == (None, "B")
    assert (two["channel_preference"], two["social_influence_factor"]) == (["social_media", "web"], Decimal("0.33"))
    profile = behavior.user_behavior_profile(events, orders, products)
    assert profile.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.USER_BEHAVIOR_PROFILE]


@pytest.mark.parametrize("kind", ["decimal(5,2)", "decimal(5,4)", "double"])
def test_targeting_against_brute_force(spark, kind):
    rng = random.Random(3)
    users = [{"user_id": u, "discount_sensitivity": Decimal(rng.randrange(0, 12000)) / 10000} for u in range(60)]
    users += [{"user_id": 60, "discount_sensitivity": None}, {"user_id": 61, "discount_sensitivity": "0.3000"}]
    counts = {u["user_id"]: (rng.randrange(5), rng.randrange(4)) for u in users[:50]}
    counts[61] = (3, 3)
    events = [
        {"event_id": f"{u}{kind}{i}", "user_id": u, "event_type": kind}
        for u, (views, carts) in counts.items()
        for kind, n in (("view", views), ("cart_add", carts))
        for i in range(n)
    ]
    strategies = [
        {"strategy_id": s, "min_discount_sensitivity": Decimal(rng.randrange(-1000, 12000, 7 if kind == "decimal(5,4)" else 100)) / 10000,
         "min_view_count": rng.randrange(4), "min_cart_count": rng.randrange(3), "trigger_type": "view",
         "action_type": "sms", "coupon_id": s}
        for s in range(30)
    ]
    strategies += [{"strategy_id": 99, "min_discount_sensitivity": "0.30", "min_view_count": 3, "min_cart_count": 3,
                    "trigger_type": "view", "action_type": "sms", "coupon_id": 9}]
    expected = {
        (u["user_id"], s["strategy_id"])
        for u in users
        for s in strategies
        if u["discount_sensitivity"] is not None
        and Decimal(u["discount_sensitivity"]) >= Decimal(s["min_discount_sensitivity"])
        and counts.get(u["user_id"], (0, 0))[0] >= s["min_view_count"]
        and counts.get(u["user_id"], (0, 0))[1] >= s["min_cart_count"]
    }
    wide = StructType([StructField(f.name, DecimalType(5, 4) if "sensitivity" in f.name else f.dataType) for f in schemas.COUPON_STRATEGY])
    asked = b.table(spark, wide, strategies)
    asked = asked.withColumn("min_discount_sensitivity", F.col("min_discount_sensitivity").cast(kind))
    found = behavior.coupon_targeting(
        b.events(spark, events),
        b.users(spark, users),
        asked,
    )
    rows = [(r.user_id, r.strategy_id) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected
    assert (61, 99) in expected
    assert found.where(F.col("action_type") != "sms").count() == 0


@pytest.mark.parametrize("cuts,salts", [(11, 8), (3, 1), (1, 2)])
def test_dominance_join_meets_few_pairs_that_fail(spark, cuts, salts):
    """Three bounds, few of which one alone would pick out: candidates stay near the matches, none is missed."""
    rng = random.Random(cuts)
    have = [(i, rng.choice([None, *range(100)]), rng.randrange(100), rng.randrange(100)) for i in range(900)]
    have += [(2000 + i, 50, 50, 50) for i in range(300)]
    least = [(i, rng.randrange(100), rng.randrange(100), rng.choice([None, *range(100)])) for i in range(300)]
    left = spark.createDataFrame(have, "l long, a int, b int, c int")
    right = spark.createDataFrame(least, "r long, x int, y int, z int")
    expected = {
        (k, m)
        for k, *own in have
        for m, *asked in least
        if all(o is not None and q is not None and o >= q for o, q in zip(own, asked))
    }
    found = [(r.l, r.r) for r in behavior.dominance_join(left, right, ["a", "b", "c"], ["x", "y", "z"], cuts, salts).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    candidates = behavior.dominance_candidates(left, right, ["a", "b", "c"], ["x", "y", "z"], cuts, salts)
    untested = candidates.where(F.size("_tests") == 0).select("l", "r").collect()
    assert {tuple(r) for r in untested} <= expected
    if cuts == 11:
        assert candidates.count() < 1.5 * len(expected)
        assert len(untested) > 0.5 * len(expected)


def test_dominance_join_on_few_values_tests_nothing_in_vain(spark):
    left = spark.createDataFrame([(i, i % 30) for i in range(90)], "l long, a int")
    right = spark.createDataFrame([(1, 0), (2, 7), (3, 29), (4, 7), (5, 31)], "r long, x int")
    candidates = behavior.dominance_candidates(left, right, ["a"], ["x"])
    assert candidates.count() == behavior.dominance_join(left, right, ["a"], ["x"]).count() == 90 + 2 * 69 + 3


def test_dominance_join_of_nothing(spark):
    none = spark.createDataFrame([], "l long, a int")
    right = spark.createDataFrame([], "r long, x int")
    assert behavior.dominance_join(none, right, ["a"], ["x"]).isEmpty()
    assert behavior.dominance_join(spark.range(1).selectExpr("id AS l", "1 AS a"), right, ["a"], ["x"]).isEmpty()
