"""Queries over values that are not finite, and over keys that are not unique."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.evaluation import join_methods
from tidewatch.operators.features import difference_features
from tidewatch.operators.linear_ae import robust_z_flags
from tidewatch.operators.outliers import detect_outliers
from tidewatch.plans.catalog.shared import rounded, scored_events
from tidewatch.sources.series import table


def _holed(spark, folder):
    """Events of which some values are infinite and some are not a number."""
    value = (
        F.when(F.col("event_id") % 97 == 0, float("inf"))
        .when(F.col("event_id") % 89 == 0, float("nan"))
        .otherwise(F.col("value"))
    )
    return table(spark, folder, "events").select("event_id", "ts", value.alias("value"))


def _outliers(spark, folder):
    z = detect_outliers(_holed(spark, folder), ["value"], "zscore", 3.0).withColumnRenamed("value_outlier", "z_outlier")
    both = detect_outliers(z, ["value"], "iqr", 1.5)
    return both.select("event_id", "z_outlier", F.col("value_outlier").alias("iqr_outlier"))


def _differences(spark, folder):
    made = difference_features(_holed(spark, folder), ["value"], [1], order_by=["ts", "event_id"], fill="none")
    return rounded(made.select("event_id", "value_diff_1", "value_pct_change_1"))


def _robust(spark, folder):
    flagged = robust_z_flags(_holed(spark, folder), "value")
    return rounded(flagged.select("event_id", "robust_z", "is_anomaly"))


def _repeated_keys(spark, folder):
    """Flags by user: a user has many events, and some events name no user."""
    events = scored_events(spark, folder).select(
        F.when(F.col("user_id") % 5 > 0, F.col("user_id")).alias("user_id"), "event_type", "is_anomaly"
    )
    return join_methods(events, events.where("event_type <> 'click'"), ["user_id"])


QUERIES = {
    "outliers_nonfinite": _outliers,
    "diff_nonfinite": _differences,
    "robust_z_nonfinite": _robust,
    "joined_methods_repeated_keys": _repeated_keys,
}

_HOLED = """holed AS (
          SELECT event_id, ts, CASE WHEN event_id % 97 = 0 THEN 'inf'::DOUBLE WHEN event_id % 89 <> 0 THEN value END AS value
          FROM events)"""

SQL = {
    "outliers_nonfinite": f"""
        WITH {_HOLED}, q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM holed)
        SELECT event_id, false AS z_outlier,
               coalesce(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a), false) AS iqr_outlier
        FROM holed, q""",
    "diff_nonfinite": f"""
        WITH {_HOLED}, l AS (SELECT event_id, value AS v, lag(value) OVER (ORDER BY ts, event_id) AS e FROM holed)
        SELECT event_id, round(CASE WHEN NOT (isinf(v) AND isinf(e)) THEN v - e END, 6) AS value_diff_1,
               round(CASE WHEN e = 0 THEN CASE WHEN v > 0 THEN 'inf'::DOUBLE WHEN v < 0 THEN '-inf'::DOUBLE END
                          WHEN NOT (isinf(v) AND isinf(e)) THEN v / e - 1 END, 6) AS value_pct_change_1
        FROM l""",
    "robust_z_nonfinite": f"""
        WITH {_HOLED}, m AS (SELECT quantile_cont(value, 0.5) AS med FROM holed),
        s AS (SELECT quantile_cont(abs(value - med), 0.5) AS mad, any_value(med) AS med FROM holed, m)
        SELECT event_id, round((value - med) / (1.4826 * mad), 6) AS robust_z,
               coalesce(abs((value - med) / (1.4826 * mad)) > 3.5, false) AS is_anomaly
        FROM holed, s""",
    "joined_methods_repeated_keys": """
        WITH e AS (SELECT CASE WHEN user_id % 5 > 0 THEN user_id END AS user_id, event_type, value > 60 AS flag FROM events)
        SELECT user_id, bool_or(flag) AS first_flag, bool_or(flag) FILTER (event_type <> 'click') AS second_flag,
               count(*) AS first_rows, count(*) FILTER (event_type <> 'click') AS second_rows
        FROM e GROUP BY user_id""",
}
