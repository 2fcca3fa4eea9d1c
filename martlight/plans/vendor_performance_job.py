"""Vendor-performance job: features, label, training, evaluation, scoring, write-back."""

from __future__ import annotations

import argparse
import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from martlight.functions.columns import DateLike
from martlight.operators.features import vendor_features, vendor_performance_labels
from martlight.operators.scoring import Evaluated, fit_vendor_performance, score_vendors
from martlight.schemas import TABLES
from martlight.session import build_session, materialize, scratch
from martlight.sources.warehouse import Warehouse, save_table

log = logging.getLogger(__name__)


def run(
    orders: DataFrame,
    products: DataFrame,
    vendors: DataFrame,
    as_of: DateLike,
    model_path: str,
    folder: str | None = None,
) -> tuple[Evaluated, DataFrame]:
    """Train the model and score all vendors with the saved copy; the features stay below ``folder``."""
    labelled = vendor_performance_labels(vendor_features(orders, products, vendors))
    features = materialize(labelled, "vendor-features", folder)
    result = fit_vendor_performance(features)
    result.model.write().overwrite().save(model_path)
    log.info("%s %.4f, model saved to %s", result.metric_name, result.metric, model_path)
    return result, score_vendors(features, PipelineModel.load(model_path), as_of)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--end-date", required=True, help="features and scores are as of this day")
    parser.add_argument("--database", default="retail")
    parser.add_argument("--model-path", required=True)
    args = parser.parse_args(argv)
    spark = build_session("vendor-performance")
    warehouse = Warehouse(spark, database=args.database)
    tables = [warehouse.table(t) for t in ("fact_order", "dim_product", "dim_vendor")]
    with scratch(spark, "vendor-performance") as folder:
        _, scores = run(*tables, args.end_date, args.model_path, folder=folder)
        save_table(scores, f"{args.database}.vendor_performance_score", TABLES["vendor_performance_score"])


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
