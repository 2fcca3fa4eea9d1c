"""User-risk job: features, label, training, evaluation, scoring, write-back.

    spark-submit --py-files ... martlight/plans/user_risk_job.py --end-date 2025-07-01 --model-path /models/user-risk
"""

from __future__ import annotations

import argparse
import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from martlight.functions.columns import DateLike
from martlight.operators.features import CURRENT_RULES, RiskRules, user_risk_labels, user_risk_labels_v1
from martlight.operators.scoring import (
    USER_FEATURES,
    USER_FEATURES_V1,
    Evaluated,
    fit_user_risk,
    score_users,
)
from martlight.schemas import TABLES
from martlight.session import build_session, materialize, scratch
from martlight.sources.warehouse import Warehouse, save_table

log = logging.getLogger(__name__)


def train_user_risk(features: DataFrame, model_path: str, inputs: list[str] = USER_FEATURES) -> Evaluated:
    """Fit, evaluate and save the model."""
    result = fit_user_risk(features, inputs)
    result.model.write().overwrite().save(model_path)
    log.info("%s %.4f, model saved to %s", result.metric_name, result.metric, model_path)
    return result


def run(
    orders: DataFrame,
    users: DataFrame,
    as_of: DateLike,
    model_path: str,
    rules: RiskRules = CURRENT_RULES,
    folder: str | None = None,
) -> tuple[Evaluated, DataFrame]:
    """Train on the current rules and score all users with the saved model; the features stay below ``folder``."""
    features = materialize(user_risk_labels(orders, users, as_of, rules), "user-risk-features", folder)
    result = train_user_risk(features, model_path)
    return result, score_users(features, PipelineModel.load(model_path), as_of)


def run_v1(orders: DataFrame, users: DataFrame, as_of: DateLike, model_path: str) -> tuple[Evaluated, DataFrame]:
    """The earlier variant: its own rules, VIP level as a feature, users with orders only."""
    features = materialize(user_risk_labels_v1(orders, users, as_of), "user-risk-features-v1")
    result = train_user_risk(features, model_path, USER_FEATURES_V1)
    return result, score_users(features, PipelineModel.load(model_path), as_of, USER_FEATURES_V1)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--end-date", required=True, help="features and scores are as of this day")
    parser.add_argument("--database", default="retail")
    parser.add_argument("--model-path", required=True)
    args = parser.parse_args(argv)
    spark = build_session("user-risk")
    warehouse = Warehouse(spark, database=args.database)
    inputs = [warehouse.table(t) for t in ("fact_order", "dim_user")]
    with scratch(spark, "user-risk") as folder:
        _, scores = run(*inputs, args.end_date, args.model_path, folder=folder)
        save_table(scores, f"{args.database}.user_credit_score", TABLES["user_credit_score"])


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
