"""Intermediate tables in the folder the cluster shares, so that they outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: elsewhere other machines could
    not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return a scan of it.

    Cuts the lineage, and gives later steps column pruning and pushdown on the stored rows.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, once their results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/meterline/{spark.sparkContext.applicationId}"
