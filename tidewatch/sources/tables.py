"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.missing import nan_to_null


def load_parquet(spark: SparkSession, path: str, *, nanosecond_columns: Sequence[str] = ()) -> DataFrame:
    """Read Parquet with NaN as NULL; a missing path raises.

    Files that hold nanosecond timestamps are unreadable for Spark as such. Name those columns and they are read as
    integers (a session setting) and turned into microsecond timestamps.
    """
    if nanosecond_columns:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    typed = {
        c: F.timestamp_micros(F.expr(f"`{c}` div 1000")).cast("timestamp_ntz")
        for c in nanosecond_columns
        if isinstance(df.schema[c].dataType, T.LongType)
    }
    return nan_to_null(df.withColumns(typed) if typed else df)


def save_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> str:
    """Write Parquet, replacing what is there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def load_csv(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read CSV with a header. Types are inferred (one more pass over the file) unless a schema is given."""
    reader = spark.read.options(**{"header": True, "inferSchema": schema is None, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.csv(path))


def save_csv(df: DataFrame, path: str, *, single_file: bool = False, **options) -> str:
    """Write CSV with a header, replacing what is there; ``single_file`` is for small ranked tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**{"header": True, **options}).csv(path)
    return path


def raw_path(root: str, source: str, dataset_id: str) -> str:
    return f"{root.rstrip('/')}/raw/{source}/{dataset_id}.parquet"


def processed_path(root: str, source: str, dataset_id: str) -> str:
    return f"{root.rstrip('/')}/processed/{source}/{dataset_id}.parquet"


def load_ingested(spark: SparkSession, dataset_ids: Sequence[str], root: str, source: str) -> dict[str, DataFrame]:
    """Raw tables by id; a missing one raises."""
    return {d: load_parquet(spark, raw_path(root, source, d)) for d in dataset_ids}
