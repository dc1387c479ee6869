"""Monitoring of a stream: scoring with a stored model, and windowed quality and anomaly rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.missing import value
from tidewatch.operators.forest import ForestModel
from tidewatch.sources.staging import staging_path


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The files of a table as a stream; the table may be a folder of files or one file."""
    table = spark._jvm.org.apache.hadoop.fs.Path(path)
    if table.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(table).isFile():
        # A stream lists folders; the filter leaves the one file of its folder.
        options["pathGlobFilter"], path = table.getName(), table.getParent().toString()
    return spark.readStream.schema(schema).options(**options).parquet(path)


def score_stream(stream: DataFrame, model: ForestModel, threshold: float | None = None) -> DataFrame:
    """Anomaly columns for every arriving row; no state is kept."""
    return model.get_anomalies(stream, threshold)


def windowed_rates(
    stream: DataFrame,
    time_col: str,
    flag: Column,
    *,
    value_cols: Sequence[str] = (),
    by: Sequence[str] = (),
    window: str = "1 day",
    watermark: str | None = None,
) -> DataFrame:
    """Rows, flagged rows and missing values per tumbling window (and dimension).

    Counts, not rates, so that partial aggregates of the same window can be merged. Windows are cut in the column's own
    clock: a timestamp without a zone is not moved by the zone of the session. A ``watermark`` bounds the state of a
    stream that never ends and drops rows that come later than it; without one every row counts.
    """
    keyed = stream.withWatermark(time_col, watermark) if watermark else stream
    missing = [F.count_if(value(stream, c).isNull()).alias(f"{c}_missing") for c in value_cols]
    grouped = keyed.groupBy(F.window(time_col, window).alias("__window"), *by)
    counted = grouped.agg(F.count("*").alias("rows"), F.count_if(flag).alias("anomalies"), *missing)
    counts = [c for c in counted.columns if c not in ("__window", *by)]
    return counted.select(F.col("__window.start").cast("timestamp_ntz").alias("window_start"), *by, *counts)


def append_available(rows: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Process what is available of a stream without state and return every row written.

    The file sink commits each micro-batch once, so a batch that is repeated after a failure leaves one copy.
    """
    query = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(target)
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


def run_available(updates: DataFrame, keys: Sequence[str], target: str, checkpoint: str) -> DataFrame:
    """Process what is available and return the latest state of every key.

    Each micro-batch replaces its own folder, so a batch that is repeated after a failure leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    latest = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    written = updates.sparkSession.read.option("basePath", target).parquet(target)
    return written.withColumn("__n", F.row_number().over(latest)).where(F.col("__n") == 1).drop("__n", "batch")


def daily_anomaly_rates(
    spark: SparkSession, path: str, schema: T.StructType, time_col: str, flag: Column, **options
) -> DataFrame:
    """Windowed rates of all files present of a table, late rows included, processed as a stream in as many batches as needed."""
    base = staging_path(spark, "stream")
    stream = read_parquet_stream(spark, path, schema)
    rates = windowed_rates(stream, time_col, flag, **options)
    keys = ["window_start", *options.get("by", ())]
    state = run_available(rates, keys, f"{base}/updates", f"{base}/checkpoint")
    return state.withColumn("anomaly_rate", F.try_divide(F.col("anomalies"), F.col("rows")))
