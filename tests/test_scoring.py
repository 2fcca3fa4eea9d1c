import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from martlight.operators import scoring
from martlight.plans import user_risk_job, vendor_performance_job
from martlight.schemas import TABLES
from martlight.session import materialize, shared_dir
from martlight.sources import warehouse
from tests import builders as b


@pytest.fixture(scope="module")
def labelled(spark):
    features = spark.range(400).select(
        F.col("id").alias("user_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100))).cast("double").alias(c) for c in scoring.USER_FEATURES],
    )
    risky = (F.col("monetary") > 60).cast("double")
    return materialize(features.withColumn("label", risky).coalesce(1), "test-features")


def test_split_does_not_depend_on_partitioning(spark):
    ids = spark.range(5000).withColumnRenamed("id", "user_id")
    once = {r.user_id for r in scoring.train_test_split(ids.repartition(1), "user_id")[0].collect()}
    again = {r.user_id for r in scoring.train_test_split(ids.repartition(7), "user_id")[0].collect()}
    assert once == again and 0.78 < len(once) / 5000 < 0.82
    assert scoring.train_test_split(ids, "user_id")[1].count() == 5000 - len(once)


def test_user_model_is_repeatable_and_round_trips(spark, labelled):
    first = scoring.fit_user_risk(labelled, trees=20)
    second = scoring.fit_user_risk(labelled, trees=20)
    shuffled = scoring.fit_user_risk(labelled.repartition(5, "monetary"), trees=20)
    assert first.metric == second.metric == shuffled.metric > 0.9
    assert first.train_rows + first.test_rows == 400
    path = shared_dir(spark, "test-model")
    first.model.write().overwrite().save(path)
    here = scoring.score_users(labelled, first.model, "2025-07-01")
    loaded = scoring.score_users(labelled, PipelineModel.load(path), "2025-07-01")
    assert sorted(here.collect()) == sorted(loaded.collect())
    assert loaded.dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES["user_credit_score"].schema]
    rows = loaded.collect()
    assert len({r.user_id for r in rows}) == 400
    assert all(0 <= r.risk_score <= 1 and r.is_high_risk in (0.0, 1.0) for r in rows)


def test_unknown_tenure_is_scored(spark, labelled):
    model = scoring.fit_user_risk(labelled, trees=3).model
    holes = labelled.withColumn("user_tenure", F.lit(None).cast("int"))
    assert scoring.score_users(holes, model, "2025-07-01").count() == 400


def test_user_job_scores_every_user_and_writes_back(spark):
    orders = b.orders(
        spark,
        [
            {"user_id": u, "order_date": "2025-06-25", "net_amount": 100 * u, "discount_amount": u % 7,
             "order_status": "Returned" if u % 5 == 0 else "Completed",
             "payment_method": "prepaid_card" if u % 4 == 0 else "credit_card"}
            for u in range(60)
            for _ in range(2)
        ],
    )
    users = b.users(
        spark,
        [{"user_id": u, "registration_date": "2024-01-01", "credit_score": 300 + 5 * u, "vip_level": u % 6} for u in range(80)],
    )
    result, scores = user_risk_job.run(orders, users, "2025-07-01", shared_dir(spark, "job-model"))
    assert result.metric_name == "areaUnderROC" and 0 <= result.metric <= 1
    assert scores.count() == 80
    warehouse.create_database(spark, "scores_test")
    path = shared_dir(spark, "job-scores")
    for _ in range(2):
        warehouse.save_table(scores, "scores_test.user_credit_score", TABLES["user_credit_score"], path=path)
    assert spark.table("scores_test.user_credit_score").count() == 80
    spark.sql("DROP DATABASE scores_test CASCADE")

    _, earlier = user_risk_job.run_v1(orders, users, "2025-07-01", shared_dir(spark, "job-model-v1"))
    assert earlier.count() == 60


def test_vendor_job(spark):
    vendors = b.vendors(
        spark,
        [{"vendor_id": v, "vendor_name": f"v{v}", "cost_price": 10 + v, "avg_delivery_time": 1 + v % 8} for v in range(40)],
    )
    products = b.products(spark, [{"product_id": p, "vendor_id": p % 35, "unit_price": 20 + p} for p in range(100)])
    orders = b.orders(spark, [{"vendor_id": o % 30, "net_amount": o} for o in range(300)])
    result, scores = vendor_performance_job.run(orders, products, vendors, "2025-07-01", shared_dir(spark, "vendor-model"))
    assert result.metric_name == "rmse" and result.metric >= 0
    assert scores.count() == 40
    assert scores.dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES["vendor_performance_score"].schema]


@pytest.mark.parametrize("parallelism", [1, 2, 64])
def test_trees_do_not_depend_on_the_cluster(spark, labelled, monkeypatch, parallelism):
    from pyspark import SparkContext

    expected = scoring.fit_user_risk(labelled, trees=5, rows_per_task=50)
    monkeypatch.setattr(SparkContext, "defaultParallelism", parallelism)
    spread = labelled.repartition(parallelism)
    found = scoring.fit_user_risk(spread, trees=5, rows_per_task=50)
    assert found.model.stages[-1].toDebugString.split("\n")[1:] == expected.model.stages[-1].toDebugString.split("\n")[1:]
    assert found.metric == expected.metric
