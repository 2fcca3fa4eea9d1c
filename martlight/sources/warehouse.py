"""Warehouse tables: look-up by name, layout on write, registration in the catalog."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.schemas import TABLES, TableSpec
from martlight.session import hadoop_path


class Warehouse:
    """Tables of one database of the session's catalog, or of one folder of files."""

    def __init__(self, spark: SparkSession, database: str | None = None, path: str | None = None):
        if (database is None) == (path is None):
            raise ValueError("give either a database or a path")
        self.spark = spark
        self.database = database
        self.path = None if path is None else path.rstrip("/")

    def table(self, name: str, *columns: str) -> DataFrame:
        """The table, or just ``columns`` of it."""
        if self.database is not None:
            df = self.spark.table(f"{self.database}.{name}")
        else:
            spec = TABLES[name]
            df = self.spark.read.schema(spec.schema).format(spec.file_format).load(f"{self.path}/{name}")
        return df.select(*columns) if columns else df


def hadoop_exists(spark: SparkSession, location: str) -> bool:
    path, files = hadoop_path(spark, location)
    return files.exists(path)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of the declared table, by name, in declared order and type."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def _gathered(df: DataFrame, spec: TableSpec, buckets: tuple[int, str] | None = None) -> DataFrame:
    """Bring rows of one output file together, in tasks of bounded size.

    A rebalance, unlike a repartition, splits a folder that outgrows one task,
    so a day, country or user holding most rows is written by many tasks.
    """
    by = list(spec.partition_by)
    if buckets is not None:
        count, key = buckets
        df = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(count)))
        by.append("_bucket")
    return df.hint("rebalance", *by).drop("_bucket") if by else df


def _writer(df: DataFrame, spec: TableSpec):
    writer = df.write.format(spec.file_format)
    if spec.file_format == "orc":
        writer = writer.option("compression", "zlib")
    return writer.partitionBy(*spec.partition_by) if spec.partition_by else writer


def write_files(df: DataFrame, name: str, path: str) -> None:
    """Write a whole table to ``path``/``name`` in its declared format and partitions."""
    spec = TABLES[name]
    rows = _gathered(conform(df, spec), spec)
    # The session may be set to replace partitions only; a whole table leaves no old rows.
    writer = _writer(rows, spec).mode("overwrite").option("partitionOverwriteMode", "static")
    writer.save(f"{path.rstrip('/')}/{name}")


def replace_partitions(df: DataFrame, name: str, path: str) -> None:
    """Replace just the partitions present in ``df``; new ones are added, others survive."""
    spec = TABLES[name]
    if not spec.partition_by:
        raise ValueError(f"{name} has no partitions")
    rows = _gathered(conform(df, spec), spec)
    writer = _writer(rows, spec).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.save(f"{path.rstrip('/')}/{name}")


def partition_folder(spark: SparkSession, name: str, **partition: object) -> str:
    """The folder of a partition below its table, as Spark names it: values cast and escaped."""
    spec = TABLES[name]
    cast = [F.lit(partition[c]).cast(spec.schema[c].dataType).cast("string").alias(c) for c in spec.partition_by]
    values = spark.range(1).select(*cast).first()
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(named(c, values[c]) for c in spec.partition_by)


def load_partition(df: DataFrame, name: str, path: str, **partition: object) -> None:
    """Replace one named partition by ``df``, which may be empty; a row that belongs elsewhere is an error."""
    spec = TABLES[name]
    if set(partition) != set(spec.partition_by):
        raise ValueError(f"{name} is partitioned by {', '.join(spec.partition_by) or 'nothing'}")
    rows = conform(df, spec)
    values = {c: F.lit(v).cast(spec.schema[c].dataType) for c, v in partition.items()}
    inside = F.lit(True)
    for column, value in values.items():
        inside = inside & F.col(column).eqNullSafe(value)
    if not rows.where(~inside).isEmpty():
        raise ValueError(f"rows outside partition {partition} of {name}")
    writer = rows.drop(*partition).write.format(spec.file_format).mode("overwrite")
    if spec.file_format == "orc":
        writer = writer.option("compression", "zlib")
    writer.save(f"{path.rstrip('/')}/{name}/{partition_folder(df.sparkSession, name, **partition)}")


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location is not None else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def _create_table(spark: SparkSession, database: str, name: str, location: str, bucketed: bool) -> None:
    spec = TABLES[name]
    columns = ", ".join(f"`{f.name}` {spec.ddl_type(f.name)}" for f in spec.schema)
    clauses = [f"USING {spec.file_format}"]
    if spec.file_format == "orc":
        clauses.append("OPTIONS (compression 'zlib')")
    if spec.partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(spec.partition_by)})")
    if bucketed and spec.bucket_by is not None:
        count, key = spec.bucket_by
        clauses.append(f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {count} BUCKETS")
    clauses.append(f"LOCATION '{location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) {' '.join(clauses)}")


def create_tables(spark: SparkSession, database: str, path: str) -> None:
    """Create the database and every declared table, empty, in its full layout."""
    create_database(spark, database)
    for name in TABLES:
        _create_table(spark, database, name, f"{path.rstrip('/')}/{name}", bucketed=True)


def register_external(spark: SparkSession, database: str, name: str, location: str) -> None:
    """Register existing files as an external table and pick up their partitions.

    Files written elsewhere carry no bucket numbers, so none are declared.
    """
    _create_table(spark, database, name, location, bucketed=False)
    if TABLES[name].partition_by:
        # A reload may also have dropped partitions.
        spark.sql(f"MSCK REPAIR TABLE {database}.{name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {database}.{name}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` heeds only the session's overwrite mode, not the writer's."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def insert_overwrite(df: DataFrame, database: str, name: str) -> None:
    """Replace a created table, or of a partitioned one just the partitions in ``df``."""
    spec = TABLES[name]
    rows = _gathered(conform(df, spec), spec, spec.bucket_by)
    with _dynamic_overwrite(df.sparkSession):
        rows.write.mode("overwrite").insertInto(f"{database}.{name}")


def save_table(
    df: DataFrame, table: str, spec: TableSpec, path: str | None = None, bucketed: bool = True
) -> None:
    """Overwrite a catalog table with the declared format, partitions and buckets.

    With a ``path`` the table is external.
    """
    buckets = spec.bucket_by if bucketed else None
    writer = _writer(_gathered(conform(df, spec), spec, buckets), spec).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    if buckets is not None:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
