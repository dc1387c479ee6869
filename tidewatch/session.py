"""Session defaults shared by the tests, the bench and interactive use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "tidewatch", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for development; on a cluster use the session it hands out."""
    os.environ.setdefault("TZ", "UTC")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python call site of every column operator costs more than the operator.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
