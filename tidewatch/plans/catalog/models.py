"""Model queries: scoring and flagging by given forests, the linear autoencoder, methods side by side, streams, the run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidewatch.operators.evaluation import join_methods, method_overlap
from tidewatch.operators.forest import ForestModel, IsolationForest, average_path, node_rows
from tidewatch.operators.linear_ae import LinearAutoencoder, robust_z_flags, time_split
from tidewatch.operators.outliers import detect_outliers
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.plans.anomaly_run import DEFAULT_CONFIG, run_anomaly_detection
from tidewatch.plans.catalog.shared import REGION_DAILY, SCORED_EVENTS, rounded, scored_events
from tidewatch.sources.series import region_daily, ship_daily, table
from tidewatch.sources.staging import staging_path
from tidewatch.streaming.monitor import append_available, daily_anomaly_rates, read_parquet_stream, score_stream

# Three hand-written trees over (value, hour): (tree, node, depth, feature, split, left, right, size, path_length).
_TREES = [
    (0, 0, 0, 0, 20.0, 1, 2, 256, None),
    (0, 1, 1, -1, None, -1, -1, 128, 3.0),
    (0, 2, 1, 1, 12.0, 3, 4, 128, None),
    (0, 3, 2, -1, None, -1, -1, 64, 1.0),
    (0, 4, 2, -1, None, -1, -1, 64, 2.5),
    (1, 0, 0, 1, 6.0, 1, 2, 256, None),
    (1, 1, 1, -1, None, -1, -1, 64, 2.0),
    (1, 2, 1, 0, 100.0, 3, 4, 192, None),
    (1, 3, 2, -1, None, -1, -1, 190, 4.0),
    (1, 4, 2, -1, None, -1, -1, 2, 1.5),
    (2, 0, 0, -1, None, -1, -1, 256, 2.2),
]
FIXED_FOREST = ForestModel(
    features=["value", "hour"],
    means={"value": 20.0, "hour": 11.5},
    psi=256,
    offset=-0.8,
    n_estimators=3,
    max_samples=256,
    contamination=0.05,
    random_state=0,
    nodes=node_rows(_TREES),
)


def event_features(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", "ts", "value", F.hour("ts").alias("hour"), F.col("user_id").alias("user")
    )


def _fixed_scores(spark, folder):
    return rounded(FIXED_FOREST.get_anomalies(event_features(spark, folder)))


def _fixed_scores_with_gaps(spark, folder):
    """Missing inputs take the training mean of the column."""
    gaps = event_features(spark, folder).withColumn("value", F.when(F.col("value") > 25, F.col("value")))
    return rounded(FIXED_FOREST.score_samples(gaps))


def _sample_counts(spark, folder):
    return IsolationForest().draw_samples(event_features(spark, folder)).groupBy("tree").agg(F.count("*").alias("rows"))


def _quantile_flags(spark, folder):
    scored = scored_events(spark, folder).select("event_id", "anomaly_score")
    offset = exact_quantiles(scored, ["anomaly_score"], [0.05])["anomaly_score"][0]
    return replace(FIXED_FOREST, offset=offset).flag(scored)


def _threshold_flags(spark, folder):
    scored = scored_events(spark, folder).select("event_id", "anomaly_score")
    return replace(FIXED_FOREST, offset=-1.0).flag(scored, threshold=-0.5)


def _reconstruction(spark, folder):
    """Volume and revenue of a region day move together; the error is what one component cannot explain."""
    daily = region_daily(spark, folder)
    return rounded(LinearAutoencoder(encoding_dim=1).fit(daily, ["orders", "revenue"]).reconstruction_error(daily))


def _reconstruction_flags(spark, folder):
    daily = region_daily(spark, folder)
    return rounded(LinearAutoencoder(encoding_dim=1).fit(daily, ["orders", "revenue"]).predict(daily))


def _robust(spark, folder):
    return rounded(robust_z_flags(table(spark, folder, "events").select("event_id", "value"), "value"))


def _split_sizes(spark, folder):
    train, validation = time_split(table(spark, folder, "orders"), "o_orderdate", 0.2)

    def part(df, name):
        return df.agg(
            F.lit(name).alias("part"),
            F.count("*").alias("rows"),
            F.min("o_orderdate").alias("first_date"),
            F.max("o_orderdate").alias("last_date"),
        )

    return part(train, "train").unionByName(part(validation, "validation"))


def _both_methods(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    z = detect_outliers(events, ["value"], "zscore", 3.0).withColumnRenamed("value_outlier", "is_anomaly")
    q = detect_outliers(events, ["value"], "iqr", 1.5).withColumnRenamed("value_outlier", "is_anomaly")
    return join_methods(z, q, ["event_id"]).drop("first_rows", "second_rows")


def _stream_rates(spark, folder):
    events = table(spark, folder, "events")
    return rounded(
        daily_anomaly_rates(
            spark, f"{folder}/events.parquet", events.schema, "ts", F.col("value") > 60, value_cols=["value"]
        )
    )


def _stream_scores(spark, folder):
    """Every event scored on arrival by the fixed forest."""
    events = table(spark, folder, "events")
    stream = read_parquet_stream(spark, f"{folder}/events.parquet", events.schema)
    ready = stream.select("event_id", "value", F.hour("ts").alias("hour"))
    base = staging_path(spark, "stream")
    out = append_available(score_stream(ready, FIXED_FOREST), f"{base}/updates", f"{base}/checkpoint")
    return rounded(out)


def end_to_end(spark, folder):
    """All steps from raw tables to flags, on region days (one series per region)."""
    config = {
        **DEFAULT_CONFIG,
        "features": {**DEFAULT_CONFIG["features"], "table": "sales", "partition_by": ["region"], "order_by": ["date"]},
        "date_range": {"start": "1995-01-01", "end": "2001-08-01"},
    }
    tables = {"sales": region_daily(spark, folder), "shipping": ship_daily(spark, folder)}
    run = run_anomaly_detection(spark, tables, staging_path(spark, "run"), config)
    return run.predictions.select("date", "region", "orders", "revenue", "anomaly_score", "prediction", "is_anomaly")


QUERIES = {
    "forest_sample_counts": _sample_counts,
    "forest_score_fixed": _fixed_scores,
    "forest_score_imputed": _fixed_scores_with_gaps,
    "forest_flags": _quantile_flags,
    "forest_threshold_flags": _threshold_flags,
    "ae_reconstruction": _reconstruction,
    "ae_flags": _reconstruction_flags,
    "robust_z_flags": _robust,
    "time_split": _split_sizes,
    "joined_methods": _both_methods,
    "method_overlap": lambda s, d: rounded(method_overlap(_both_methods(s, d), "first_flag", "second_flag")),
    "stream_daily_rate": _stream_rates,
    "stream_scores": _stream_scores,
    "end_to_end_anomalies": end_to_end,
}

_SCALE = average_path(256)


def _fixed_sql(columns: str, source: str, value: str = "value") -> str:
    return f"""
        WITH e AS (SELECT event_id, ts, {value} AS value, CAST(hour(ts) AS INTEGER) AS hour, user_id AS "user"
                   FROM events),
        f AS (SELECT *, coalesce(value, 20.0) AS v FROM e),
        s AS (SELECT *, -pow(2, -((CASE WHEN v < 20 THEN 3.0 WHEN hour < 12 THEN 1.0 ELSE 2.5 END)
                                  + (CASE WHEN hour < 6 THEN 2.0 WHEN v < 100 THEN 4.0 ELSE 1.5 END) + 2.2)
                                 / 3 / CAST({_SCALE!r} AS DOUBLE)) AS score
              FROM f)
        SELECT {columns} FROM {source}"""


_FLAGGED = """CAST(CASE WHEN score < -0.8 THEN -1 ELSE 1 END AS INTEGER) AS prediction,
              round(score, 6) AS anomaly_score, score < -0.8 AS is_anomaly"""
_RECONSTRUCTION = f"""
        WITH {REGION_DAILY},
        z AS (SELECT *, (orders - avg(orders) OVER ()) / stddev_samp(orders) OVER () AS a,
                     (revenue - avg(revenue) OVER ()) / stddev_samp(revenue) OVER () AS b
              FROM region_daily),
        -- two standardised columns: the minor component is their difference (positive correlation) or their sum
        e AS (SELECT *, CASE WHEN sum(a * b) OVER () > 0 THEN (a - b) * (a - b) ELSE (a + b) * (a + b) END / 2 AS err
              FROM z)
"""
_METHODS = """
        WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events),
        m AS (SELECT event_id, abs(value - avg(value) OVER ()) / stddev_samp(value) OVER () > 3 AS first_flag,
                     value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS second_flag
              FROM events, q)"""

SQL = {
    "forest_sample_counts": """
        SELECT CAST(t AS INTEGER) AS tree, least(256, (SELECT count(*) FROM events)) AS rows FROM range(100) AS r(t)""",
    "forest_score_fixed": _fixed_sql(
        f"event_id, ts, round(value, 6) AS value, hour, \"user\", {_FLAGGED}", "s"
    ),
    "forest_score_imputed": _fixed_sql(
        "event_id, ts, round(value, 6) AS value, hour, \"user\", round(score, 6) AS anomaly_score",
        "s",
        "CASE WHEN value > 25 THEN value END",
    ),
    "forest_flags": f"""
        WITH {SCORED_EVENTS}, q AS (SELECT quantile_cont(anomaly_score, 0.05) AS o FROM scored)
        SELECT event_id, CAST(CASE WHEN anomaly_score < o THEN -1 ELSE 1 END AS INTEGER) AS prediction, anomaly_score,
               anomaly_score < o AS is_anomaly
        FROM scored, q""",
    "forest_threshold_flags": f"""
        WITH {SCORED_EVENTS}
        SELECT event_id, CAST(CASE WHEN anomaly_score < -1 THEN -1 ELSE 1 END AS INTEGER) AS prediction, anomaly_score,
               anomaly_score < -0.5 AS is_anomaly
        FROM scored""",
    "ae_reconstruction": _RECONSTRUCTION
    + "SELECT date, region, orders, round(revenue, 6) AS revenue, round(err, 6) AS reconstruction_error FROM e",
    "ae_flags": _RECONSTRUCTION
    + """, t AS (SELECT quantile_cont(err, 0.95) AS cut FROM e)
        SELECT date, region, orders, round(revenue, 6) AS revenue, round(err, 6) AS reconstruction_error,
               CAST(CASE WHEN err > cut THEN -1 ELSE 1 END AS INTEGER) AS prediction, err > cut AS is_anomaly
        FROM e, t""",
    "robust_z_flags": """
        WITH a AS (SELECT quantile_cont(value, 0.5) AS med FROM events),
        b AS (SELECT quantile_cont(abs(value - med), 0.5) AS mad, any_value(med) AS med FROM events, a)
        SELECT event_id, round(value, 6) AS value, round((value - med) / (1.4826 * mad), 6) AS robust_z,
               abs((value - med) / (1.4826 * mad)) > 3.5 AS is_anomaly
        FROM events, b""",
    "time_split": """
        WITH q AS (SELECT quantile_cont(CAST(epoch_us(o_orderdate) AS DOUBLE), 0.8) AS cut FROM orders)
        SELECT CASE WHEN epoch_us(o_orderdate) <= cut THEN 'train' ELSE 'validation' END AS part, count(*) AS rows,
               min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
        FROM orders, q GROUP BY 1""",
    "joined_methods": _METHODS + "SELECT event_id, first_flag, second_flag FROM m",
    "method_overlap": _METHODS
    + """
        SELECT count(*) FILTER (first_flag) AS first_flags, count(*) FILTER (second_flag) AS second_flags,
               count(*) FILTER (first_flag AND second_flag) AS both,
               count(*) FILTER (first_flag AND NOT second_flag) AS only_first,
               count(*) FILTER (second_flag AND NOT first_flag) AS only_second,
               round(count(*) FILTER (first_flag AND second_flag) * 1.0
                     / count(*) FILTER (first_flag OR second_flag), 6) AS overlap
        FROM m""",
    "stream_daily_rate": """
        SELECT date_trunc('day', ts) AS window_start, count(*) AS rows, count(*) FILTER (value > 60) AS anomalies,
               count(*) FILTER (value IS NULL) AS value_missing,
               round(count(*) FILTER (value > 60) * 1.0 / count(*), 6) AS anomaly_rate
        FROM events GROUP BY 1""",
    "stream_scores": _fixed_sql(f"event_id, round(value, 6) AS value, hour, {_FLAGGED}", "s"),
}
