"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "lapwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can read, as named by `spark.checkpoint.dir`."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/lapwise/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read back.

    Fixes values that would differ if a lost task were run again (range
    boundaries, partition ids) and cuts the lineage for iterative jobs.
    """
    path = shared_dir(df.sparkSession, label)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
