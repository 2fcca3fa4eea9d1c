"""Loads under a ledger: repeated, rejected, and dying at every step."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlight.schemas import TABLES
from martlight.session import shared_dir
from martlight.sources.csv_files import read_csv, write_csv
from martlight.sources.ledger import LoadLedger, LoadRejected, source_id
from martlight.sources.warehouse import Warehouse, load_partition, write_files

NAMES = ["A/B", "50%", "x", "a=b", "c:d", "", "sp ace", None]


def users(spark, level, names=NAMES, each=2):
    rows = [(i * each + j, n) for i, n in enumerate(names) for j in range(each)]
    found = spark.createDataFrame(rows, "user_id long, country string").withColumn("vip_level", F.lit(level))
    return found.select(
        *[F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["dim_user"].schema]
    )


def counted(df):
    # Spark stores an empty partition value as null.
    return Counter((r.country or None, r.vip_level) for r in df.select("country", "vip_level").collect())


def expected(**levels):
    return Counter({k: v for k, v in levels.items()})


def test_repeated_load_changes_nothing(spark):
    ledger = LoadLedger(spark, shared_dir(spark, "ledger"))
    first = ledger.load(users(spark, 1), "dim_user", "one")
    again = ledger.load(users(spark, 2), "dim_user", "one")
    assert again == first and first.row_count == 16
    assert set(counted(ledger.table("dim_user"))) == {(n or None, 1) for n in NAMES}
    assert [(r.load_id, r.state, r.row_count) for r in ledger.loads("dim_user").collect()] == [("one", "loaded", 16)]


class Died(Exception):
    pass


@pytest.mark.parametrize("after", range(7))
def test_death_between_partitions_changes_nothing(spark, after):
    base = shared_dir(spark, "ledger")
    ledger = LoadLedger(spark, base)
    ledger.load(users(spark, 1), "dim_user", "one")
    before = counted(ledger.table("dim_user"))
    seen = []

    def die(partition):
        seen.append(partition)
        if len(seen) > after:
            raise Died

    with pytest.raises(Died):
        ledger.load(users(spark, 2, NAMES + ["new"]), "dim_user", "two", moved=die)
    # Another process finds it.
    after_death = LoadLedger(spark, base)
    assert after_death.recover("dim_user") == ["two"] and after_death.recover("dim_user") == []
    assert counted(after_death.table("dim_user")) == before
    after_death.load(users(spark, 2, NAMES + ["new"]), "dim_user", "two")
    assert set(counted(after_death.table("dim_user"))) == {(n or None, 2) for n in NAMES + ["new"]}


def test_death_while_undoing(spark, monkeypatch):
    base = shared_dir(spark, "ledger")
    ledger = LoadLedger(spark, base)
    ledger.load(users(spark, 1, ["a", "b", "c"]), "dim_user", "one")
    before = counted(ledger.table("dim_user"))
    whole_move, allowed = LoadLedger._move, [0]

    def move(self, source, target):
        if not allowed[0]:
            raise Died
        allowed[0] -= 1
        whole_move(self, source, target)

    for first in range(6):
        for second in range(5):
            monkeypatch.setattr(LoadLedger, "_move", move)
            for steps, act in ((first, lambda: ledger.load(users(spark, 2, ["a", "b", "c"]), "dim_user", "two")), (second, lambda: ledger.recover("dim_user"))):
                allowed[0] = steps
                try:
                    act()
                except Died:
                    pass
            monkeypatch.setattr(LoadLedger, "_move", whole_move)
            assert counted(ledger.table("dim_user")) == before


def test_rejected_load_changes_nothing(spark):
    base = shared_dir(spark, "ledger")
    ledger = LoadLedger(spark, base)
    ledger.load(users(spark, 1), "dim_user", "one")
    before = counted(ledger.table("dim_user"))
    with pytest.raises(LoadRejected):
        ledger.load(users(spark, 2), "dim_user", "two", expected_rows=17)
    assert counted(ledger.table("dim_user")) == before
    broken = spark.createDataFrame([], TABLES["coupon_strategy"].schema)
    ledger.load(broken, "coupon_strategy", "none")
    row = [F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["coupon_strategy"].schema]
    with pytest.raises(LoadRejected):
        ledger.load(spark.range(1).select(*row), "coupon_strategy", "null")
    assert ledger.table("coupon_strategy").isEmpty()


def test_table_without_partitions(spark):
    ledger = LoadLedger(spark, shared_dir(spark, "ledger"))
    kind = TABLES["dim_product"].schema

    def products(n):
        found = spark.range(n).withColumnRenamed("id", "product_id")
        return found.select(*[F.col(f.name) if f.name == "product_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in kind])

    ledger.load(products(3), "dim_product", "one")

    def die(partition):
        raise Died

    with pytest.raises(Died):
        ledger.load(products(5), "dim_product", "two", moved=die)
    assert ledger.table("dim_product").count() == 3
    ledger.load(products(5), "dim_product", "two")
    assert ledger.table("dim_product").count() == 5


def test_source_id_follows_the_files(spark):
    base = shared_dir(spark, "ledger-files")
    write_csv(users(spark, 1), f"{base}/csv")
    first = source_id(spark, f"{base}/csv")
    assert source_id(spark, f"{base}/csv") == first
    write_csv(users(spark, 1).limit(3), f"{base}/csv")
    assert source_id(spark, f"{base}/csv") != first
    with pytest.raises(FileNotFoundError):
        source_id(spark, f"{base}/none")
    assert read_csv(spark, f"{base}/csv", "dim_user").count() == 3


@pytest.mark.parametrize("value", [n for n in NAMES if n])
def test_load_partition_meets_spark_names(spark, value):
    base = shared_dir(spark, "named")
    write_files(users(spark, 1), "dim_user", base)
    load_partition(users(spark, 3, [value], each=1), "dim_user", base, country=value)
    found = counted(Warehouse(spark, path=base).table("dim_user"))
    assert found == Counter({(n or None, 1): 2 for n in NAMES if n and n != value} | {(None, 1): 4, (value, 3): 1})
    load_partition(users(spark, 3).where("false"), "dim_user", base, country=value)
    assert (value, 3) not in counted(Warehouse(spark, path=base).table("dim_user"))


def test_load_partition_of_a_null_and_of_a_date_in_another_spelling(spark):
    base = shared_dir(spark, "named")
    write_files(users(spark, 1, ["x", None]), "dim_user", base)
    load_partition(users(spark, 4, [None], each=1), "dim_user", base, country=None)
    assert counted(Warehouse(spark, path=base).table("dim_user")) == Counter({("x", 1): 2, (None, 4): 1})
    kind = TABLES["fact_event"].schema
    day = spark.sql("SELECT DATE '2025-01-01' AS event_date, 'e' AS event_id")
    day = day.select(*[F.col(f.name) if f.name in day.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind])
    write_files(day.union(day), "fact_event", base)
    load_partition(day, "fact_event", base, event_date="2025-1-1")
    assert Warehouse(spark, path=base).table("fact_event").count() == 1
