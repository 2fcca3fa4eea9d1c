"""Orders from repeated and late events, orphans, and the declared layout."""

import re

from pyspark.sql import functions as F

from martlight.operators import rules
from martlight.plans import registry
from martlight.schemas import TABLES
from martlight.session import shared_dir
from martlight.sources.testdata import LAYOUT_WEEK, TestdataWarehouse
from martlight.sources.warehouse import Warehouse
from martlight.streaming import orders
from tests import builders as b


def test_upsert_twice_changes_nothing(spark):
    base = shared_dir(spark, "upsert")
    first = b.orders(spark, [{"order_id": i, "quantity": 1, "order_date": f"2025-01-0{1 + i % 3}"} for i in range(6)])
    for _ in range(2):
        orders.upsert_orders(first, base)
    table = Warehouse(spark, path=base)
    assert table.table("fact_order").count() == 6
    changed = b.orders(spark, [{"order_id": i, "quantity": 9, "order_date": f"2025-01-0{1 + i % 3}"} for i in (0, 0, 3, 6)])
    orders.upsert_orders(changed, base)
    found = {r.order_id: r.quantity for r in table.table("fact_order").collect()}
    assert found == {str(i): 9 if i in (0, 3, 6) else 1 for i in range(7)} and table.table("fact_order").count() == 7
    orders.upsert_orders(b.orders(spark, []), base)
    assert table.table("fact_order").count() == 7


def test_state_forgets_ids_and_the_upsert_does_not(spark):
    """An id that comes again long after its own time makes no second order."""
    base = shared_dir(spark, "stream")
    kind = "event_id string, user_id long, product_id long, event_type string, event_ts timestamp, quantity int, payment_method string, purchase_channel string"
    files = [
        [("1", "2025-01-01 10:00:00"), ("1", "2025-01-01 10:00:00"), ("2", "2025-01-01 11:00:00")],
        [("3", "2025-01-05 10:00:00"), ("2", "2025-01-01 11:00:00")],
        [("1", "2025-01-01 10:00:00"), ("4", "2025-01-04 20:00:00"), ("3", "2025-01-05 10:00:00")],
    ]
    for i, rows in enumerate(files):
        full = spark.createDataFrame([(e, t) for e, t in rows], "event_id string, t string").selectExpr(
            "event_id", "1L AS user_id", "1L AS product_id", "'purchase' AS event_type", "CAST(t AS TIMESTAMP) AS event_ts",
            "1 AS quantity", "'credit_card' AS payment_method", "'web' AS purchase_channel",
        )
        full.coalesce(1).write.parquet(f"{base}/in/part={i}")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    orders.drain_orders(
        stream,
        b.products(spark, [{"product_id": 1, "unit_price": 5, "vendor_id": 1}]),
        b.users(spark, [{"user_id": 1}]),
        b.discounts(spark, []),
        "2025-01-08 10:00:00",
        f"{base}/out",
        f"{base}/checkpoint",
        late_by="1 day",
    )
    found = Warehouse(spark, path=f"{base}/out").table("fact_order").collect()
    assert len(found) == 4 and len({r.order_id for r in found}) == 4


def test_batches_send_no_table_through_the_driver(spark, monkeypatch):
    """Neither tables nor a batch's orders are broadcast, and a batch's plans adapt to their data."""
    plans = []

    def stored(df, purpose, folder=None):
        found = store(df, purpose, folder)
        if purpose.startswith("upsert"):
            plans.append((purpose, df.sparkSession.conf.get("spark.sql.adaptive.enabled"), df._jdf.queryExecution().executedPlan().toString()))
        return found

    store = orders.store
    monkeypatch.setattr(orders, "store", stored)
    base = shared_dir(spark, "stream")
    columns = {"user_id": "1L", "product_id": "1L", "event_type": "'purchase'", "quantity": "1", "payment_method": "'credit_card'", "purchase_channel": "'web'"}
    for i in range(2):
        events = spark.range(3).selectExpr(
            f"CAST(id + {2 * i} AS STRING) AS event_id", "TIMESTAMP '2025-01-01 10:00:00' AS event_ts", *[f"{v} AS {c}" for c, v in columns.items()]
        )
        events.coalesce(1).write.parquet(f"{base}/in/part={i}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    products = b.products(spark, [{"product_id": 1, "unit_price": 5, "vendor_id": 1}])
    users = b.users(spark, [{"user_id": 1}])
    orders.drain_orders(
        stream, products, users, b.discounts(spark, []), "2025-01-08 10:00:00", f"{base}/out", f"{base}/checkpoint", late_by="1 day"
    )
    assert Warehouse(spark, path=f"{base}/out").table("fact_order").count() == 5
    assert {purpose for purpose, _, _ in plans} == {"upsert", "upsert-merged"}
    for _, adaptive, plan in plans:
        joins = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
        assert adaptive == "true" and not [j for j in joins if re.search("product_id|user_id|order_id", j)]


def test_orphans_add_up(spark):
    events = b.events(
        spark,
        [{"event_id": str(i), "user_id": u, "product_id": p, "event_type": t} for i, (u, p, t) in enumerate(
            [(1, 1, "purchase"), (2, 1, "purchase"), (1, 2, "purchase"), (2, 2, "purchase"), (None, 1, "purchase"), (1, None, "purchase"), (2, 2, "view")]
        )],
    )
    products = b.products(spark, [{"product_id": 1}])
    users = b.users(spark, [{"user_id": 1}])
    found = {r.event_id: r.reason for r in rules.purchase_orphans(events, products, users).collect()}
    assert found == {"1": "user", "2": "product", "3": "product and user", "4": "user", "5": "product"}
    counts = {r.reason: r.purchases for r in rules.orphan_counts(events, products, users).collect()}
    assert counts == {"kept": 1, "user": 2, "product": 2, "product and user": 1}


def _metrics(spark, df, node):
    """Metrics of the scans of a table in an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "FileSourceScanExec" and node in p.toString():
            found.append({k: p.metrics().apply(k).value() for k in ("numPartitions", "numFiles")})
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_week_of_the_declared_layout(spark, sf_dir):
    """Orders are partitioned by day and bucketed by user: a week's features move no order, and list seven days."""
    tables = registry.declared_layout(TestdataWarehouse(spark, sf_dir))
    df = registry.range_features(tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan orc" in line and "net_amount" in line)
    assert LAYOUT_WEEK[0] in scan and "PartitionFilters: [isnotnull(order_date" in scan
    assert "SelectedBucketsCount: 64 out of 64" in plan
    # Orders are aggregated where their buckets lie.
    above = plan[: plan.index(scan)]
    assert not re.search(r"Exchange[^\n]*user_id[^\n]*\n[^\n]*(HashAggregate|SortAggregate)", above)
    days = tables.table("fact_order").where(F.col("order_date").between(*LAYOUT_WEEK)).select("order_date").distinct().count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        listed = _metrics(spark, registry.range_features(tables), "net_amount")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [m["numPartitions"] for m in listed] == [days] and days <= 7
    assert TABLES["fact_order"].partition_by and TABLES["fact_order"].bucket_by
