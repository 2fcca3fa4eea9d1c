"""Load job: CSV interchange files into the warehouse, then into the catalog."""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import SparkSession

from martlight.session import build_session
from martlight.sources.csv_files import load_csv, read_csv
from martlight.sources.ledger import LoadLedger, source_id
from martlight.sources.warehouse import create_database, register_external

# Tables that arrive as files; the others are produced by jobs.
CSV_TABLES = (
    "dim_vendor",
    "dim_user",
    "dim_product",
    "dim_discount",
    "dim_time",
    "fact_event",
    "fact_order",
)


def run(
    spark: SparkSession,
    csv_dir: str,
    warehouse_path: str,
    database: str,
    tables: Iterable[str] = CSV_TABLES,
    replace_all: bool = True,
    once: bool = False,
) -> None:
    """Load ``csv_dir``/<table>.csv of each table and register it.

    With ``once`` loads go through the ledger: files that were loaded are not loaded again, rows are
    staged and checked first, and a load that died is undone; partitions that no file has stay.

    Without ``replace_all`` partitioned tables keep the partitions that no file has; the others
    are replaced all the same, so that new facts never meet old dimensions.
    """
    create_database(spark, database)
    ledger = LoadLedger(spark, warehouse_path)
    for name in tables:
        files = f"{csv_dir.rstrip('/')}/{name}.csv"
        if once:
            ledger.load(read_csv(spark, files, name), name, source_id(spark, files))
        else:
            load_csv(spark, files, name, warehouse_path, replace_all)
        register_external(spark, database, name, f"{warehouse_path.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("csv_dir")
    parser.add_argument("warehouse_path")
    parser.add_argument("--database", default="retail")
    parser.add_argument("--only-new-partitions", action="store_true")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args(argv)
    run(
        build_session("load"),
        args.csv_dir,
        args.warehouse_path,
        args.database,
        replace_all=not args.only_new_partitions,
        once=args.once,
    )


if __name__ == "__main__":
    main()
