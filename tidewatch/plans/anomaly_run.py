"""The full run: ingest, check, pick a table, engineer features, train, flag, evaluate, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.columns import DIMENSIONS, feature_columns, report_columns, widest_table
from tidewatch.operators.evaluation import anomaly_runs, evaluate_anomalies, flag_rate, ranked_runs
from tidewatch.operators.features import engineer_features
from tidewatch.operators.forest import ForestModel, IsolationForest
from tidewatch.operators.ordered import Layout
from tidewatch.operators.reports import evaluation_report, write_report_tables
from tidewatch.plans.quality_run import QualityResult, run_quality_checks
from tidewatch.sources.ingest import ingest_tables, normalise
from tidewatch.sources.staging import stage
from tidewatch.sources.tables import save_csv, save_parquet

# The default run.
DEFAULT_CONFIG = {
    "date_range": {"start": "2019-01-01", "end": "2023-12-31"},
    "processing": {"missing_threshold": 0.3, "outlier_std_threshold": 3.0},
    "qc": {
        "fail_fast": True,
        "required_columns": ["date"],
        "date_column": "date",
        "date_monotonic_group_by": ["region", "hospital_id"],
        "missing_threshold": 0.3,
        "fail_on_missing_threshold": False,
        "check_outliers": False,
    },
    "features": {"rolling_windows": [7, 14, 30], "lag_features": [1, 7, 30], "seasonal_features": True},
    "isolation_forest": {"n_estimators": 100, "max_samples": 256, "contamination": 0.05, "random_state": 42},
    "evaluation": {"top_k_anomalies": 20, "persistence_window": 7, "seasonality_check": True},
    "output": {"save_predictions": True, "save_features": True, "save_figures": True},
}


@dataclass
class AnomalyRun:
    datasets: dict[str, DataFrame]
    quality: QualityResult
    features: DataFrame
    predictions: DataFrame
    evaluation: dict[str, DataFrame]
    model: ForestModel
    summary: DataFrame


def run_anomaly_detection(
    spark: SparkSession,
    tables: dict[str, str | DataFrame],
    root: str,
    config: dict | None = None,
    *,
    source: str = "local",
    layout: Layout = Layout(),
) -> AnomalyRun:
    """Run all steps and write their results below ``root``.

    ``features.order_by`` and ``features.partition_by`` in the config name the row order and the series. The order
    must be unique; by default it is the date with the dimensions and then the metrics as tie-breakers.
    ``features.table`` names the table to analyse; by default it is the widest one. All tables are checked.
    """
    config = DEFAULT_CONFIG if config is None else config
    output = config.get("output") or {}
    results = f"{root.rstrip('/')}/results"

    datasets = ingest_tables(spark, tables, root, source)
    quality = run_quality_checks(spark, datasets, config, f"{results}/qc_report.json")

    chosen = normalise(datasets[(config.get("features") or {}).get("table") or widest_table(datasets)])
    order_by, partition_by = _ordering(chosen, config)
    features = engineer_features(chosen, config, order_by=order_by, partition_by=partition_by, layout=layout)
    # Training, scoring and evaluation all read the features: write them once, read them back.
    if output.get("save_features", True):
        path = save_parquet(features, f"{results}/features.parquet")
        features = spark.read.schema(features.schema).parquet(path)
    else:
        features = stage(features, "features")

    params = config.get("isolation_forest") or {}
    known = {k: v for k, v in params.items() if k in IsolationForest.__dataclass_fields__}
    key = [*partition_by, *order_by]
    model, scored = IsolationForest(**known).fit_score(features, feature_columns(features), key)
    predictions = model.flag(scored)
    model.save(spark, f"{results}/isolation_forest")

    evaluation = evaluate_anomalies(
        predictions, config, order_by=order_by, partition_by=partition_by, layout=layout
    )
    if output.get("save_predictions", True):
        write_evaluation(evaluation, flag_rate(predictions), results)
        runs = anomaly_runs(predictions, order_by=order_by, partition_by=partition_by, layout=layout)
        top = (config.get("evaluation") or {}).get("top_k_anomalies", 20)
        save_csv(ranked_runs(runs, top, tiebreak=partition_by), f"{results}/anomaly_windows.csv", single_file=True)
    if output.get("save_figures", True):
        write_report_tables(predictions, report_columns(chosen), f"{results}/report")
    return AnomalyRun(datasets, quality, features, predictions, evaluation, model, flag_rate(predictions))


def write_evaluation(evaluation: dict[str, DataFrame], summary: DataFrame, results: str) -> None:
    """The most severe rows as CSV, and all evaluation numbers as JSON, one object for each."""
    save_csv(evaluation["top_anomalies"], f"{results}/anomalies.csv", single_file=True)
    report = evaluation_report(evaluation, summary)
    report.coalesce(1).write.mode("overwrite").json(f"{results}/evaluation.json")


def _ordering(df: DataFrame, config: dict) -> tuple[list[str], list[str]]:
    settings = config.get("features") or {}
    partition_by = list(settings.get("partition_by") or [])
    order_by = settings.get("order_by") or [c for c in DIMENSIONS if c in df.columns] + report_columns(df)
    return [c for c in order_by if c not in partition_by], partition_by
