"""What a run writes, read back; and methods side by side."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.columns import report_columns
from tidewatch.operators.evaluation import evaluate_anomalies, flag_rate, method_disagreements, top_per_method
from tidewatch.operators.ordered import DAILY
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.reports import write_report_tables
from tidewatch.plans.anomaly_run import DEFAULT_CONFIG, write_evaluation
from tidewatch.plans.catalog.quality import SQL as QUALITY_SQL
from tidewatch.plans.catalog.quality import _REPORT_CONFIG
from tidewatch.plans.catalog.shared import SCORED_DAILY, rounded, scored_daily
from tidewatch.plans.quality_run import run_quality_checks
from tidewatch.sources.series import gappy_events, table
from tidewatch.sources.staging import staging_path
from tidewatch.sources.tables import load_csv

_BY_REGION = {"order_by": ["date"], "partition_by": ["region"], "layout": DAILY}


def _saved_quality(spark, folder):
    """The checks of the JSON report."""
    path = f"{staging_path(spark, 'quality')}/qc_report.json"
    config = {**_REPORT_CONFIG, "qc": {**_REPORT_CONFIG["qc"], "fail_fast": False}}
    run_quality_checks(spark, {"events": gappy_events(spark, folder)}, config, path)
    checks = "array<struct<check:string,column:string,metric:string,bound:double,value:double,passed:boolean>>"
    report = spark.read.schema(f"dataset_id string, checks {checks}").json(path)
    return rounded(report.select("dataset_id", F.inline("checks")))


def _evaluated(spark, folder):
    """Where the evaluation of scored region days was written."""
    scored = scored_daily(spark, folder)
    results = staging_path(spark, "evaluation")
    write_evaluation(evaluate_anomalies(scored, DEFAULT_CONFIG, **_BY_REGION), flag_rate(scored), results)
    return scored, results


def _saved_evaluation(spark, folder):
    _, results = _evaluated(spark, folder)
    schema = "section string, key string, measure string, value double"
    return rounded(spark.read.schema(schema).json(f"{results}/evaluation.json"))


def _saved_top(spark, folder):
    scored, results = _evaluated(spark, folder)
    return load_csv(spark, f"{results}/anomalies.csv", schema=scored.schema)


def _saved_overlay(spark, folder):
    """The overlay of all report columns."""
    scored = scored_daily(spark, folder)
    path = staging_path(spark, "report")
    metrics = [c for c in report_columns(scored) if c not in ("anomaly_score", "is_anomaly")]
    overlay, *_ = write_report_tables(scored, metrics, path)
    return spark.read.parquet(overlay)


def _two_methods(spark, folder):
    """Events by distance from the mean and by distance from the quartiles; lower scores are more severe."""
    events = table(spark, folder, "events").select("event_id", "value")
    a, b = exact_quantiles(events, ["value"], [0.25, 0.75])["value"]
    m, s = events.agg(F.avg("value"), F.stddev_samp("value")).first()
    x = F.col("value")
    scored = events.select(
        "event_id",
        (-F.round(F.abs(x - m) / s, 6)).alias("z"),
        (-F.round(F.greatest(a - x, x - b) / (b - a), 6)).alias("q"),
    )
    return scored.withColumns({"by_z": F.col("z") < -2.0, "by_q": F.col("q") < -1.5})


QUERIES = {
    "saved_qc_report": _saved_quality,
    "saved_evaluation": _saved_evaluation,
    "saved_top_anomalies": _saved_top,
    "saved_overlay": _saved_overlay,
    "top_per_method": lambda s, d: top_per_method(
        _two_methods(s, d), {"zscore": ("z", "by_z"), "iqr": ("q", "by_q")}, 15, keys=["event_id"]
    ),
    "method_disagreements": lambda s, d: method_disagreements(
        _two_methods(s, d), ("z", "by_z"), ("q", "by_q"), 15, keys=["event_id"]
    ),
}

_TWO_METHODS = """
        WITH facts AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m,
                              stddev_samp(value) AS s FROM events),
        scored AS (SELECT event_id, -round(abs(value - m) / s, 6) AS z, -round(greatest(a - value, value - b) / (b - a), 6) AS q
                   FROM events, facts)"""


def _long(section: str, key: str, source: str, measures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {key} AS key, '{m}' AS measure, round(CAST({x} AS DOUBLE), 6) AS value FROM {source}"
        for m, x in measures.items()
    )


_TOTALS = {"rows": "count(*)", "anomalies": "count(*) FILTER (is_anomaly)", "anomaly_rate": "avg(CAST(is_anomaly AS INTEGER))"}
_PERSISTENT = {
    "total_anomalies": "count(*) FILTER (is_anomaly)",
    "persistent_anomalies": "count(*) FILTER (n > 1)",
    "persistence_rate": "count(*) FILTER (n > 1) * 1.0 / count(*) FILTER (is_anomaly)",
}
_STABLE = {
    "mean_score": "avg(anomaly_score)",
    "std_score": "stddev_samp(anomaly_score)",
    "cv_mean": "avg(cv)",
    "cv_std": "stddev_samp(cv)",
    "score_range": "max(anomaly_score) - min(anomaly_score)",
}
_RATES = {"sum": "sum(CAST(is_anomaly AS INTEGER))", "count": "count(is_anomaly)", "mean": "avg(CAST(is_anomaly AS INTEGER))"}

SQL = {
    "saved_qc_report": QUALITY_SQL["qc_report"],
    "saved_evaluation": f"""
        WITH {SCORED_DAILY},
        w AS (SELECT *, sum(CAST(is_anomaly AS INTEGER)) OVER (PARTITION BY region ORDER BY date
                          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n,
                     stddev_samp(anomaly_score) OVER (PARTITION BY region ORDER BY date
                          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
                     / avg(anomaly_score) OVER (PARTITION BY region ORDER BY date
                          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS cv FROM scored)
        {_long("summary", "''", "w", _TOTALS)} UNION ALL {_long("persistence", "''", "w", _PERSISTENT)}
        UNION ALL {_long("stability", "''", "w", _STABLE)}
        UNION ALL {" UNION ALL ".join(
            _long("seasonality", f"'{g}-' || {g}(date)", "w", {m: x}) + f" GROUP BY {g}(date)"
            for g in ("month", "quarter") for m, x in _RATES.items())}""",
    "saved_top_anomalies": f"""
        WITH {SCORED_DAILY}
        SELECT date, region, orders, revenue, anomaly_score, is_anomaly FROM scored
        ORDER BY anomaly_score NULLS LAST, date, region LIMIT 20""",
    "saved_overlay": f"""
        WITH {SCORED_DAILY}
        SELECT date, is_anomaly, 'orders' AS metric, CAST(orders AS DOUBLE) AS value FROM scored
        UNION ALL SELECT date, is_anomaly, 'revenue', revenue FROM scored""",
    "top_per_method": f"""{_TWO_METHODS},
        each AS (SELECT event_id, 'zscore' AS method, z AS score FROM scored WHERE z < -2
                 UNION ALL SELECT event_id, 'iqr', q FROM scored WHERE q < -1.5)
        SELECT * FROM (SELECT event_id, method, score, CAST(row_number() OVER (PARTITION BY method ORDER BY score, event_id)
                       AS INTEGER) AS rank FROM each) WHERE rank <= 15""",
    "method_disagreements": f"""{_TWO_METHODS},
        each AS (SELECT event_id, 'only_first' AS side, z AS score FROM scored WHERE z < -2 AND NOT q < -1.5
                 UNION ALL SELECT event_id, 'only_second', q FROM scored WHERE q < -1.5 AND NOT z < -2)
        SELECT * FROM (SELECT event_id, side, score, CAST(row_number() OVER (PARTITION BY side ORDER BY score, event_id)
                       AS INTEGER) AS rank FROM each) WHERE rank <= 15""",
}
