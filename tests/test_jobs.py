"""The command-line jobs end to end: files to tables, tables to scores."""

import uuid

from martlight.plans import load_job, user_risk_job, vendor_performance_job
from martlight.sources.csv_files import write_csv
from tests import builders as b


def test_load_then_both_scoring_jobs(spark, tmp_path):
    database = f"jobs_{uuid.uuid4().hex[:8]}"
    users = [
        {"user_id": u, "gender": "F", "registration_date": "2024-01-01", "credit_score": 300 + 9 * u, "country": "China"}
        for u in range(60)
    ]
    vendors = [
        {"vendor_id": v, "vendor_name": f"v{v}", "cost_price": 10 + v, "distribution_areas": ["a"], "country": "China"}
        for v in range(20)
    ]
    products = [{"product_id": p, "vendor_id": p % 20, "unit_price": 20 + p, "category": "A>x"} for p in range(40)]
    orders = [
        {"order_id": str(o), "user_id": o % 50, "product_id": o % 40, "vendor_id": o % 20, "net_amount": 10 + o,
         "discount_amount": 1, "order_date": f"2025-06-{1 + o % 3:02d}"}
        for o in range(200)
    ]
    tables = {
        "dim_user": b.users(spark, users),
        "dim_vendor": b.vendors(spark, vendors),
        "dim_product": b.products(spark, products),
        "fact_order": b.orders(spark, orders),
    }
    for name, df in tables.items():
        write_csv(df, f"{tmp_path}/csv/{name}.csv")
    load_job.run(spark, f"{tmp_path}/csv", f"{tmp_path}/warehouse", database, tables)

    arguments = ["--database", database, "--end-date", "2025-07-01", "--model-path"]
    user_risk_job.main([*arguments, f"{tmp_path}/user-model"])
    vendor_performance_job.main([*arguments, f"{tmp_path}/vendor-model"])
    scored = spark.table(f"{database}.user_credit_score")
    assert scored.count() == 60 and str(scored.first().scoring_date) == "2025-07-01"
    assert spark.table(f"{database}.vendor_performance_score").count() == 20
    spark.sql(f"DROP DATABASE {database} CASCADE")
