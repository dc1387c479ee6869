"""Intermediate tables that cut lineage.

A staged table is an ordinary Parquet folder below the shared directory named by ``spark.checkpoint.dir``, so it
survives the loss of any executor and can be read with column pruning by the next step.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    # Single-machine sessions (tests, bench) may leave it unset.
    root = tempfile.mkdtemp(prefix="tidewatch-")
    sc.setCheckpointDir(root)
    return root


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/tidewatch/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
