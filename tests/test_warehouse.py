import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlight.plans import load_job
from martlight.schemas import TABLES, TableSpec
from martlight.sources import warehouse
from martlight.sources.csv_files import load_csv, read_csv, reject_counts, rejects, write_csv
from tests import builders as b


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _file(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_traps(spark, tmp_path):
    orders = _file(
        tmp_path / "fact_order.csv",
        "order_id,user_id,product_id,discount_id,time_id,vendor_id,quantity,gross_amount,discount_amount,net_amount,"
        "payment_method,purchase_channel,order_status,province,city,order_date",
        "a,9007199254740993,2,3.0,20250101,4,1,10.5,0.0,10.5,credit_card,web,Completed,广东,深圳,2025-01-01",
        "b,1,2,,20250102,4,x,10.5,0.0,10.5,credit_card,web,Completed,广东,深圳,2025-13-45",
    )
    rows = {r.order_id: r for r in read_csv(spark, orders, "fact_order").collect()}
    assert (rows["a"].discount_id, rows["a"].user_id, rows["a"].city) == (3, 9007199254740993, "深圳")
    assert (rows["b"].discount_id, rows["b"].quantity, rows["b"].order_date) == (None, None, None)
    assert rows["a"].order_date == dt.date(2025, 1, 1)

    vendors = _file(
        tmp_path / "dim_vendor.csv",
        "vendor_id,vendor_name,country,cost_price,market_price,vendor_rating,service_quality,avg_delivery_time,"
        "vendor_return_rate,distribution_areas",
        """1,"甲, 乙",China,10.0,11.0,3.5,4.0,2,0.01,"['华东', '华南']" """.strip(),
    )
    row = read_csv(spark, vendors, "dim_vendor").first()
    assert (row.vendor_name, row.country, row.distribution_areas) == ("甲, 乙", "China", ["华东", "华南"])

    products = _file(
        tmp_path / "dim_product.csv",
        "product_id,category,brand,unit_price,stock,description,implicit_attributes,vendor_id",
        '1,服装>男装,Nike,99.9,5,好,"{""color"": ""红"", ""size"": ""XL""}",7',
    )
    assert read_csv(spark, products, "dim_product").first().implicit_attributes == '{"color": "红", "size": "XL"}'
    assert read_csv(spark, products, "dim_product").dtypes == [
        (f.name, f.dataType.simpleString()) for f in TABLES["dim_product"].schema
    ]


def test_csv_sink_round_trip_of_arrays_and_quotes(spark, tmp_path):
    vendors = b.vendors(
        spark,
        [
            {"vendor_id": 1, "vendor_name": 'say "hi", ok', "cost_price": 1, "distribution_areas": ["a", "b"]},
            {"vendor_id": 2, "vendor_name": None, "cost_price": None, "distribution_areas": None},
        ],
    )
    write_csv(vendors, str(tmp_path / "v"))
    assert sorted(read_csv(spark, str(tmp_path / "v"), "dim_vendor").collect()) == sorted(vendors.collect())


def test_partition_replace_keeps_the_others(spark, tmp_path):
    path = str(tmp_path)
    rows = [{"user_id": 1, "order_date": "2025-01-01"}, {"user_id": 2, "order_date": "2025-01-02"}]
    warehouse.write_files(b.orders(spark, rows), "fact_order", path)
    update = [{"user_id": 5, "order_date": "2025-01-02"}, {"user_id": 6, "order_date": "2025-01-03"}]
    write_csv(b.orders(spark, update), f"{path}/csv")
    load_csv(spark, f"{path}/csv", "fact_order", path, replace_all=False)
    found = warehouse.Warehouse(spark, path=path).table("fact_order", "user_id", "order_date")
    assert {(r.user_id, r.order_date.day) for r in found.collect()} == {(1, 1), (5, 2), (6, 3)}
    assert {p.name for p in (tmp_path / "fact_order").glob("order_date=*")} == {f"order_date=2025-01-0{d}" for d in (1, 2, 3)}
    assert all(".zlib.orc" in p.name for p in (tmp_path / "fact_order").glob("*/*.orc"))
    with pytest.raises(ValueError):
        warehouse.replace_partitions(spark.range(1), "dim_product", path)


def test_load_job_registers_tables(spark, tmp_path, database):
    users = b.users(spark, [{"user_id": 1, "gender": "F", "country": "China"}, {"user_id": 2, "gender": "M", "country": "USA"}])
    write_csv(users, f"{tmp_path}/in/dim_user.csv")
    load_job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", database, ["dim_user"])
    found = warehouse.Warehouse(spark, database=database).table("dim_user", "user_id", "gender", "country")
    assert sorted(map(tuple, found.collect())) == [(1, "F", "China"), (2, "M", "USA")]
    declared = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {database}.dim_user").collect()}
    assert declared["gender"] == "char(1)"
    assert spark.catalog.getTable(f"{database}.dim_user").tableType == "EXTERNAL"


def test_dim_time_is_parquet(spark, tmp_path):
    from martlight.operators.rules import calendar

    days = calendar(spark.sql("SELECT DATE '2025-01-01' AS first_day, DATE '2025-01-03' AS last_day"))
    warehouse.write_files(days, "dim_time", str(tmp_path))
    assert list((tmp_path / "dim_time").glob("*.parquet"))
    assert warehouse.Warehouse(spark, path=str(tmp_path)).table("dim_time").count() == 3


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One day holds nearly all rows; its folder is split, nothing is lost."""
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["fact_order"].schema if f.name not in ("order_id", "order_date")],
        F.when(F.col("id") % 50 == 0, F.lit("2025-01-02")).otherwise("2025-01-01").cast("date").alias("order_date"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        warehouse.write_files(rows.repartition(8), "fact_order", str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list((tmp_path / "fact_order" / "order_date=2025-01-01").glob("*.orc"))) > 2
    assert warehouse.Warehouse(spark, path=str(tmp_path)).table("fact_order").count() == 200_000


def test_bucketed_orders_are_not_shuffled(spark, tmp_path, database):
    from martlight.operators.features import user_risk_features

    warehouse.create_database(spark, database)
    orders = b.orders(spark, [{"user_id": u % 40, "order_date": "2025-01-01", "net_amount": u} for u in range(200)])
    users = b.users(spark, [{"user_id": u, "country": "China"} for u in range(50)])
    for name, df in (("fact_order", orders), ("dim_user", users)):
        spec = TABLES[name]
        by_bucket = TableSpec(spec.schema, spec.file_format, (), spec.bucket_by)
        warehouse.save_table(df, f"{database}.{name}", by_bucket, path=f"{tmp_path}/{name}")
    tables = warehouse.Warehouse(spark, database=database)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = user_risk_features(tables.table("fact_order"), tables.table("dim_user"), "2025-07-01")
        plan = result._jdf.queryExecution().executedPlan().toString()
        # The orders aggregate and join in place; only the users move to meet their 64 buckets.
        moved = plan[plan.index("Exchange") :]
        assert plan.count("Exchange") == 1 and "dim_user" in moved and "fact_order" not in moved
        # Row by row, both tables join in place: 64 buckets are read as 32.
        direct = tables.table("fact_order", "user_id").join(tables.table("dim_user", "user_id"), "user_id")
        assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()
        expected = user_risk_features(orders, users, "2025-07-01")
        assert sorted(map(str, result.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_declared_layout_with_partitions_and_buckets(spark, tmp_path, database):
    warehouse.create_database(spark, database)
    users = b.users(spark, [{"user_id": u, "country": "China" if u % 3 else "USA"} for u in range(100)])
    warehouse.save_table(users, f"{database}.dim_user", TABLES["dim_user"], path=f"{tmp_path}/u")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.dim_user").collect()}
    assert described["Num Buckets"] == "32" and described["Bucket Columns"] == "[`user_id`]"
    assert spark.table(f"{database}.dim_user").count() == 100
    assert len(list((tmp_path / "u" / "country=USA").glob("*.orc"))) <= 32


def test_created_tables_take_inserts_in_their_layout(spark, tmp_path, database):
    warehouse.create_tables(spark, database, str(tmp_path))
    assert {t.name for t in spark.catalog.listTables(database)} == set(TABLES)
    tables = warehouse.Warehouse(spark, database=database)
    assert all(tables.table(name).dtypes == [(f.name, f.dataType.simpleString()) for f in spec.schema] or name == "dim_user" for name, spec in TABLES.items())

    users = b.users(spark, [{"user_id": u, "gender": "F", "country": "China" if u % 3 else "USA"} for u in range(100)])
    warehouse.insert_overwrite(users, database, "dim_user")
    usa = b.users(spark, [{"user_id": 500, "gender": "M", "country": "USA"}])
    warehouse.insert_overwrite(usa, database, "dim_user")
    found = tables.table("dim_user", "user_id", "gender", "country").collect()
    assert len(found) == 67 and {r.user_id for r in found if r.country == "USA"} == {500}
    spark.sql(f"REFRESH TABLE {database}.dim_user")
    plan = tables.table("dim_user").groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 32 out of 32" in plan

    strategies = b.table(spark, TABLES["coupon_strategy"].schema, [{"strategy_id": 1, "min_view_count": 2}])
    for _ in range(2):
        warehouse.insert_overwrite(strategies, database, "coupon_strategy")
    assert tables.table("coupon_strategy").count() == 1


def test_warehouse_needs_one_location(spark):
    with pytest.raises(ValueError):
        warehouse.Warehouse(spark)


def test_second_load_replaces_the_first(spark, tmp_path, database):
    users = [{"user_id": u, "country": c, "gender": "F"} for u, c in enumerate(["China", "USA", "Japan", "Peru"])]
    for rows in (users, [users[1] | {"user_id": 9}, users[2]]):
        write_csv(b.users(spark, rows), f"{tmp_path}/in/dim_user.csv")
        load_job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", database, ["dim_user"])
        found = spark.table(f"{database}.dim_user").collect()
        assert {(r.user_id, r.country) for r in found} == {(r["user_id"], r["country"]) for r in rows}
    assert spark.sql(f"SHOW PARTITIONS {database}.dim_user").count() == 2


def test_whole_table_write_leaves_no_old_rows(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for rows in ([{"user_id": 1, "order_date": "2025-01-01"}, {"user_id": 2, "order_date": "2025-01-02"}], [{"user_id": 3, "order_date": "2025-01-02"}]):
            warehouse.write_files(b.orders(spark, rows), "fact_order", str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.user_id for r in warehouse.Warehouse(spark, path=str(tmp_path)).table("fact_order", "user_id").collect()] == [3]


def test_unpartitioned_tables_are_replaced_with_new_partitions(spark, tmp_path, database):
    for ids in ([1, 2], [3]):
        write_csv(b.products(spark, [{"product_id": i} for i in ids]), f"{tmp_path}/in/dim_product.csv")
        write_csv(b.users(spark, [{"user_id": i, "country": f"c{i}"} for i in ids]), f"{tmp_path}/in/dim_user.csv")
        load_job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", database, ["dim_product", "dim_user"], replace_all=False)
    assert [r.product_id for r in spark.table(f"{database}.dim_product").collect()] == [3]
    assert {r.user_id for r in spark.table(f"{database}.dim_user").collect()} == {1, 2, 3}


def test_files_with_other_columns_and_rejects(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _file(folder / "a.csv", "product_id,stock,unit_price,brand", "1,2,3.5,x", "2,3.0,1,y", "3,3.7,oops,z", "4,1", "5,1,1,x,9")
    _file(folder / "b.csv", "brand,unit_price,product_id,stock,extra", "w,7.25,6,4,e", "v,,7,1e3,e")
    (folder / "c.csv").write_text("")
    rows = {r.product_id: (r.stock, r.unit_price, r.brand) for r in read_csv(spark, str(folder), "dim_product").collect()}
    assert {k: (s, None if p is None else float(p), x) for k, (s, p, x) in rows.items()} == {
        1: (2, 3.5, "x"), 2: (3, 1.0, "y"), 3: (None, None, "z"), 6: (4, 7.25, "w"), 7: (None, None, "v"),
    }
    found = rejects(spark, str(folder), "dim_product")
    assert sorted(((r.column_name or "", r.value) for r in found.collect())) == [
        ("", "4,1"), ("", "5,1,1,x,9"), ("stock", "1e3"), ("stock", "3.7"), ("unit_price", "oops"),
    ]
    assert {r.column_name: r.rejected for r in reject_counts(found).collect()} == {None: 2, "stock": 2, "unit_price": 1}
    headerless = _file(tmp_path / "users.csv", "user_id,user_name", "1,x")
    with pytest.raises(ValueError):
        read_csv(spark, headerless, "dim_user")


def test_lists_and_line_breaks_survive_files(spark, tmp_path):
    lists = [[], None, ["d'Or", "b"], ["a", None], ['q"x', "a,b"]]
    vendors = b.vendors(spark, [{"vendor_id": i, "vendor_name": "two\nlines", "distribution_areas": x} for i, x in enumerate(lists)])
    write_csv(vendors, str(tmp_path / "v"))
    found = read_csv(spark, str(tmp_path / "v"), "dim_vendor", multi_line=True).collect()
    assert {r.vendor_id: r.distribution_areas for r in found} == dict(enumerate(lists))
    assert {r.vendor_name for r in found} == {"two\nlines"}
    literal = _file(tmp_path / "w.csv", "vendor_id,distribution_areas,country", """1,"[""d'Or"", 'b']",x""")
    assert read_csv(spark, literal, "dim_vendor").first().distribution_areas == ["d'Or", "b"]


def test_named_partition(spark, tmp_path):
    path = str(tmp_path)
    users = [{"user_id": u, "country": c} for u, c in enumerate(["China", "USA", "Japan"])]
    warehouse.write_files(b.users(spark, users), "dim_user", path)
    with pytest.raises(ValueError):
        warehouse.load_partition(b.users(spark, users), "dim_user", path, country="USA")
    with pytest.raises(ValueError):
        warehouse.load_partition(b.users(spark, users), "dim_user", path, city="USA")
    warehouse.load_partition(b.users(spark, [{"user_id": 7, "country": "USA"}]), "dim_user", path, country="USA")
    warehouse.load_partition(b.users(spark, []), "dim_user", path, country="Japan")
    found = warehouse.Warehouse(spark, path=path).table("dim_user", "user_id", "country").collect()
    assert {tuple(r) for r in found} == {(0, "China"), (7, "USA")}


def test_scratch_folder_goes(spark, tmp_path):
    from martlight.session import materialize, scratch

    with scratch(spark, "t") as folder:
        assert materialize(spark.range(3), "x", folder).count() == 3
        local = Path(folder.removeprefix("file:"))
        assert local.exists()
    assert not local.exists()


def test_only_odd_integers_are_matched(spark, tmp_path):
    """Plain digits are parsed as they stand; other spellings give what the pattern says."""
    spelt = {
        "7": 7, "-7": -7, "7.0": 7, "0": 0, "2147483647": 2147483647, "-2147483648.0": -2147483648,
        "+7": 7, " 7 ": 7, "\t7": 7, "7.": 7, "7.00": 7, "007": 7, "-0": 0, "-0.0": 0, "+7.0": 7, " 7.0": 7, "7.0 ": 7,
        "2147483648": None, "7.5": None, "7e0": None, "x": None, ".0": None, "-": None, "7 .0": None, "7.0.0": None,
        "\x017": None, "7\x7f": None, "\x017.0": None, "٧": None, "": None,
    }
    rows = [f'{i},"{text}"' for i, text in enumerate(spelt)]
    file = _file(tmp_path / "p.csv", "product_id,stock", *rows)
    df = read_csv(spark, file, "dim_product")
    assert {r.product_id: r.stock for r in df.collect()} == dict(enumerate(spelt.values()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # product_id and stock; the missing vendor_id needs none.
    assert plan.count("regexp_extract(") == plan.count("ELSE cast(regexp_extract(") + plan.count("ELSE try_cast(regexp_extract(") == 2
