"""Report tables: what a plot of the results would show."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.calendar import parse_date
from tidewatch.functions.columns import present
from tidewatch.operators.evaluation import persistence_rate


def anomaly_overlay(
    df: DataFrame,
    metrics: Sequence[str],
    *,
    date_col: str = "date",
    anomaly_col: str = "is_anomaly",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Long series (metric, date, value, is_anomaly), one row per metric and input row."""
    metrics = present(df, list(metrics))
    slim = df.select(*keys, date_col, anomaly_col, *[F.col(f"`{m}`").cast("double").alias(m) for m in metrics])
    return slim.unpivot([*keys, date_col, anomaly_col], metrics, "metric", "value")


def score_series(
    df: DataFrame,
    *,
    date_col: str = "date",
    score_col: str = "anomaly_score",
    threshold: float | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(date, score, threshold); the threshold is missing when none is given."""
    return df.select(
        *keys, date_col, F.col(score_col).alias("score"), F.lit(threshold).cast("double").alias("threshold")
    )


def monthly_anomaly_rate(df: DataFrame, *, date_col: str = "date", anomaly_col: str = "is_anomaly") -> DataFrame:
    """(month, anomaly_rate)."""
    typed = parse_date(df, date_col).where(F.col(date_col).isNotNull())
    return typed.groupBy(F.month(date_col).alias("month")).agg(
        F.avg(F.col(anomaly_col).cast("int")).alias("anomaly_rate")
    )


def evaluation_report(evaluation: dict[str, DataFrame], summary: DataFrame) -> DataFrame:
    """All evaluation numbers as long rows (section, key, measure, value): totals, persistence, stability, and the rates of
    each month and quarter. The tables behind it have a few rows each."""
    sections = [("summary", summary, [])]
    if "persistence" in evaluation:
        sections.append(("persistence", persistence_rate(evaluation["persistence"]), []))
    sections += [(name, evaluation[name], keys) for name, keys in _SECTIONS.items() if name in evaluation]
    parts = []
    for name, table, keys in sections:
        measures = [c for c in table.columns if c not in keys]
        said = F.concat_ws("-", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
        doubles = [F.col(m).cast("double").alias(m) for m in measures]
        long = table.select(said.alias("key"), *doubles).unpivot(["key"], measures, "measure", "value")
        parts.append(long.select(F.lit(name).alias("section"), "key", "measure", "value"))
    return reduce(DataFrame.unionByName, parts)


_SECTIONS = {"stability": [], "seasonality": ["grain", "key"]}


def write_report_tables(
    df: DataFrame, metrics: Sequence[str], output_path: str, *, threshold: float | None = None
) -> list[str]:
    """Write the overlay (split by metric), the score series and the monthly rates; returns the paths written."""
    base = output_path.rstrip("/")
    written = []
    shown = present(df, list(metrics))
    if shown:
        anomaly_overlay(df, shown).write.mode("overwrite").partitionBy("metric").parquet(f"{base}/series_with_anomalies")
        written.append(f"{base}/series_with_anomalies")
    score_series(df, threshold=threshold).write.mode("overwrite").parquet(f"{base}/anomaly_scores")
    monthly_anomaly_rate(df).write.mode("overwrite").parquet(f"{base}/seasonal_distribution")
    return [*written, f"{base}/anomaly_scores", f"{base}/seasonal_distribution"]
