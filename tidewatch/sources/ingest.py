"""Ingestion: raw copy, metadata record and normalised copy of every table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.calendar import parse_date
from tidewatch.functions.columns import snake_case_names
from tidewatch.sources.tables import load_csv, load_parquet, processed_path, raw_path, save_parquet

#: Fields of a metadata record, fixed values.
METADATA_FIELDS = ("source", "dataset_id", "retrieval_date", "provider", "url", "description", "note")


def normalise(df: DataFrame) -> DataFrame:
    """Typed ``date`` column and stable column names."""
    return snake_case_names(parse_date(df, "date"))


def metadata_row(spark: SparkSession, dataset_id: str, source: str, details: dict[str, str] | None = None) -> DataFrame:
    """One row describing where a table came from and when it was fetched."""
    details = details or {}
    known = {"source": F.lit(source), "dataset_id": F.lit(dataset_id), "retrieval_date": F.current_timestamp()}
    columns = [known.get(f, F.lit(details.get(f)).cast("string")).alias(f) for f in METADATA_FIELDS]
    return spark.range(1).select(*columns)


def ingest_tables(
    spark: SparkSession,
    tables: dict[str, str | DataFrame],
    root: str,
    source: str = "local",
    details: dict[str, dict[str, str]] | None = None,
    reading: dict[str, dict] | None = None,
) -> dict[str, DataFrame]:
    """Store each table (a path or a DataFrame) raw and normalised with a metadata record; returns the raw tables.

    ``reading`` gives, by table, what ``load_csv`` or ``load_parquet`` should know about a path: a schema, CSV options,
    nanosecond columns. The returned tables are scans of the written raw files, so later steps do not repeat the
    extraction.
    """
    if not tables:
        raise ValueError("no tables to ingest")
    out = {}
    for dataset_id, given in tables.items():
        df = _open(spark, given, **(reading or {}).get(dataset_id, {})) if isinstance(given, str) else given
        raw = raw_path(root, source, dataset_id)
        save_parquet(df, raw)
        out[dataset_id] = load_parquet(spark, raw)
        about = metadata_row(spark, dataset_id, source, (details or {}).get(dataset_id))
        about.coalesce(1).write.mode("overwrite").json(raw.removesuffix(".parquet") + "_metadata.json")
        save_parquet(normalise(out[dataset_id]), processed_path(root, source, dataset_id))
    return out


def _open(spark: SparkSession, path: str, **how: object) -> DataFrame:
    load = load_csv if path.endswith((".csv", ".csv.gz")) else load_parquet
    return load(spark, path, **how)
