"""Quality checks over a set of tables, with a verdict per table and a written report."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import numeric_columns
from tidewatch.operators.outliers import outlier_summary
from tidewatch.operators.quality import (
    REPORT_SCHEMA,
    QualityError,
    failure_text,
    group_columns,
    groups_with_missing_dates,
    quality_table,
)


@dataclass
class QualityResult:
    """``report`` holds one row per check and column; ``groups`` the groups with undated rows and ``columns`` the column
    names per dataset."""

    report: DataFrame
    status: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    groups: dict[str, DataFrame] = field(default_factory=dict)
    columns: dict[str, list[str]] = field(default_factory=dict)


def run_quality_checks(
    spark: SparkSession, tables: dict[str, DataFrame], config: dict, report_path: str | None = None
) -> QualityResult:
    """Check every table. With ``qc.fail_fast`` (default) the first failure writes the report so far and raises."""
    qc = config.get("qc") or {}
    date_col = qc.get("date_column", "date")
    rows: list = []
    result = QualityResult(report=spark.createDataFrame([], REPORT_SCHEMA))
    for dataset_id, df in tables.items():
        # A handful of rows per column of the table, whatever its length.
        checks = quality_table(df, dataset_id, config).collect()
        if qc.get("check_outliers", False) and numeric_columns(df):
            checks += _outlier_rows(df, dataset_id, config).collect()
        rows += checks
        error = failure_text(checks, qc.get("fail_on_missing_threshold", False))
        result.status[dataset_id] = "failed" if error else "passed"
        result.columns[dataset_id] = list(df.columns)
        if date_col in df.columns and (keys := group_columns(df, qc)):
            result.groups[dataset_id] = groups_with_missing_dates(df, date_col, keys)
        result.report = spark.createDataFrame(rows, REPORT_SCHEMA)
        if error:
            result.errors[dataset_id] = error
            if qc.get("fail_fast", True):
                if report_path:
                    write_report(result, report_path)
                raise QualityError(error)
    if report_path:
        write_report(result, report_path)
    return result


def _outlier_rows(df: DataFrame, dataset_id: str, config: dict) -> DataFrame:
    threshold = (config.get("processing") or {}).get("outlier_std_threshold", 3.0)
    counts = outlier_summary(df, threshold)
    return counts.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit("outliers").alias("check"),
        "column",
        F.lit("zscore_count").alias("metric"),
        F.lit(float(threshold)).alias("bound"),
        F.col("outliers").cast("double").alias("value"),
        F.lit(None).cast("boolean").alias("passed"),
    )


def nested_report(result: QualityResult) -> DataFrame:
    """One row per dataset: status, error and all its checks as an array, ready for a JSON sink."""
    spark = result.report.sparkSession
    verdicts = spark.createDataFrame(
        [(d, s, result.errors.get(d), result.columns.get(d)) for d, s in result.status.items()],
        "dataset_id string, status string, error string, columns array<string>",
    )
    entries = F.collect_list(F.struct("check", "column", "metric", "bound", "value", "passed")).alias("checks")
    per_dataset = result.report.groupBy("dataset_id").agg(entries)
    return verdicts.join(per_dataset, "dataset_id", "left").withColumn("timestamp", F.current_timestamp())


def undated_groups(result: QualityResult) -> DataFrame | None:
    """(dataset_id, group, missing_dates): all groups with undated rows; the group's columns as a map."""
    parts = []
    for dataset_id, groups in result.groups.items():
        keys = [c for c in groups.columns if c != "missing_dates"]
        pairs = [x for c in keys for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
        parts.append(groups.select(F.lit(dataset_id).alias("dataset_id"), F.create_map(*pairs).alias("group"), "missing_dates"))
    return reduce(DataFrame.union, parts) if parts else None


def write_report(result: QualityResult, path: str) -> None:
    """JSON, one object per dataset; groups with undated rows, of which there may be many, are a table beside it."""
    nested_report(result).coalesce(1).write.mode("overwrite").json(path)
    groups = undated_groups(result)
    if groups is not None and not groups.isEmpty():
        groups.write.mode("overwrite").json(f"{path.removesuffix('.json')}_groups.json")
