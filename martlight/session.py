"""Session settings and the shared folder jobs write intermediate tables to."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Everything here is a Spark setting a cluster may also set for itself.
# ANSI mode is left on: operators ask for NULL-on-error where they want it.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: split an oversized join partition even if that adds a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Rows of long texts: what a Python worker holds at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # dim_user has half as many buckets as fact_order; join them without a shuffle.
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
}

# Where intermediate tables go while a block of ``scratch_tables`` runs.
_scope: ContextVar[str | None] = ContextVar("scratch", default=None)


def build_session(app_name: str = "martlight", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the recommended settings, then ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent along (``--py-files``), and a path that
    workers don't have does no harm.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one named by ``spark.checkpoint.dir``.

    Executors and driver must both see it. A session that names none gets a folder
    inside its warehouse, which they share as well; on a cluster a warehouse of local files is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        base = f"{warehouse}/_scratch"
    return f"{base.rstrip('/')}/martlight/{purpose}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, location: str) -> tuple:
    """The location as a path of the cluster's file systems, and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(location.replace(" ", "%20")))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate data."""
    path, files = hadoop_path(spark, folder)
    files.delete(path, True)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A fresh shared folder that is removed when the block ends."""
    folder = shared_dir(spark, purpose)
    try:
        yield folder
    finally:
        remove(spark, folder)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove what ``store`` and ``materialize`` wrote within the block, so the result must be written by its end."""
    with scratch(spark, "scope") as folder:
        token = _scope.set(folder)
        try:
            yield
        finally:
            _scope.reset(token)


def store(df: DataFrame, purpose: str, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder (or below ``folder``); what is read back, and where it lies.

    Cuts the lineage with data that outlives any executor, and pins the rows
    an iterative consumer sees.
    """
    if folder is not None:
        path = f"{folder}/{purpose}"
    elif (scope := _scope.get()) is not None:
        path = f"{scope}/{purpose}-{uuid.uuid4().hex}"
    else:
        path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """``df`` as ``store`` reads it back."""
    return store(df, purpose, folder)[0]
