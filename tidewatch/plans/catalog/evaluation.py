"""Ranking, evaluation and report queries over deterministic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.evaluation import (
    anomaly_persistence,
    anomaly_runs,
    flag_rate,
    persistence_rate,
    prior_years_month_mean,
    ranked_runs,
    seasonal_distribution,
    stability_metrics,
)
from tidewatch.operators.ordered import DAILY, SPREAD
from tidewatch.operators.ranking import top_anomalies, top_flagged, top_per_series
from tidewatch.operators.reports import anomaly_overlay, monthly_anomaly_rate, score_series
from tidewatch.plans.catalog.shared import (
    REGION_DAILY,
    SCORED_DAILY,
    SCORED_EVENTS,
    rounded,
    scored_daily,
    scored_events,
)
from tidewatch.sources.series import region_daily
from tidewatch.operators.features import rolling_features
from tidewatch.operators.outliers import detect_outliers

_GLOBAL = {"order_by": ["ts", "event_id"], "layout": SPREAD}
_BY_USER = {"order_by": ["ts", "event_id"], "partition_by": ["user_id"]}


def unusual_region_days(spark, folder):
    """Region days whose order volume is furthest from normal, with their weekly context."""
    daily = region_daily(spark, folder)
    weekly = rolling_features(daily, ["orders"], [7], order_by=["date"], partition_by=["region"], layout=DAILY)
    flagged = detect_outliers(weekly, ["orders"], "zscore", 2.0)
    severity = flagged.withColumn("deviation", F.abs(F.col("orders") - F.col("orders_rolling_mean_7")))
    top = top_anomalies(severity, "deviation", 20, ascending=False, tiebreak=["date", "region"])
    return rounded(
        top.select("date", "region", "orders", "orders_rolling_mean_7", "orders_rolling_std_7", "orders_outlier")
    )


def _persistence(spark, folder):
    slim = scored_events(spark, folder).select("event_id", "ts", "is_anomaly")
    return anomaly_persistence(slim, window=7, **_GLOBAL)


QUERIES = {
    "unusual_region_days": unusual_region_days,
    "top_anomalies": lambda s, d: top_anomalies(scored_events(s, d), "anomaly_score", 20, tiebreak=["event_id"]),
    "top_anomalies_desc": lambda s, d: top_anomalies(
        scored_events(s, d), "anomaly_score", 20, ascending=False, tiebreak=["event_id"]
    ),
    "top_flagged": lambda s, d: top_flagged(
        scored_daily(s, d), "anomaly_score", ["date", "region", "anomaly_score"], 10, tiebreak=["date", "region"]
    ),
    "top_per_series": lambda s, d: top_per_series(
        scored_events(s, d), "anomaly_score", 5, partition_by=["event_type"], tiebreak=["event_id"]
    ),
    "persistence": _persistence,
    "persistence_by_user": lambda s, d: anomaly_persistence(
        scored_events(s, d).select("event_id", "ts", "user_id", "is_anomaly"), window=7, **_BY_USER
    ),
    "persistence_rate": lambda s, d: rounded(persistence_rate(_persistence(s, d))),
    "flag_rate": lambda s, d: rounded(flag_rate(scored_daily(s, d))),
    "seasonal_anomaly_rates": lambda s, d: rounded(seasonal_distribution(scored_daily(s, d))),
    "stability_metrics": lambda s, d: rounded(stability_metrics(scored_events(s, d), **_GLOBAL)),
    "anomaly_overlay": lambda s, d: anomaly_overlay(scored_daily(s, d), ["orders", "revenue"], keys=["region"]),
    "score_series": lambda s, d: score_series(scored_events(s, d), date_col="ts", threshold=-0.6, keys=["event_id"]),
    "monthly_anomaly_rate": lambda s, d: rounded(monthly_anomaly_rate(scored_daily(s, d))),
    "anomaly_runs": lambda s, d: anomaly_runs(scored_events(s, d), **_GLOBAL),
    "anomaly_runs_by_user": lambda s, d: anomaly_runs(scored_events(s, d), **_BY_USER),
    "anomaly_windows_ranked": lambda s, d: ranked_runs(
        anomaly_runs(scored_events(s, d), **_BY_USER), 20, tiebreak=["user_id"]
    ),
    "prior_year_month": lambda s, d: rounded(
        prior_years_month_mean(region_daily(s, d), "orders", partition_by=["region"])
    ),
}

_TIME = "ORDER BY ts, event_id"


def _count(over: str) -> str:
    return f"CAST(sum(CAST(is_anomaly AS INTEGER)) OVER ({over} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT)"


def _runs(keys: str, over: str) -> str:
    columns = "".join(f"{k}, " for k in keys.split())
    return f"""
        WITH {SCORED_EVENTS},
        k AS (SELECT *, count(*) FILTER (NOT is_anomaly)
                     OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM scored)
        SELECT {columns}min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_length,
               min(anomaly_score) AS worst_score
        FROM k WHERE is_anomaly GROUP BY {columns}run"""


SQL = {
    "unusual_region_days": f"""
        WITH {REGION_DAILY},
        w AS (SELECT date, region, orders,
                     avg(orders) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m,
                     stddev_samp(orders) OVER (PARTITION BY region ORDER BY date
                                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sd,
                     abs((orders - avg(orders) OVER ()) / stddev_samp(orders) OVER ()) > 2 AS orders_outlier
              FROM region_daily)
        SELECT date, region, orders, round(m, 6) AS orders_rolling_mean_7, round(sd, 6) AS orders_rolling_std_7,
               orders_outlier
        FROM w ORDER BY abs(orders - m) DESC, date, region LIMIT 20""",
    "top_anomalies": f"WITH {SCORED_EVENTS} SELECT * FROM scored ORDER BY anomaly_score, event_id LIMIT 20",
    "top_anomalies_desc": f"WITH {SCORED_EVENTS} SELECT * FROM scored ORDER BY anomaly_score DESC, event_id LIMIT 20",
    "top_flagged": f"""
        WITH {SCORED_DAILY}
        SELECT date, region, anomaly_score FROM scored WHERE is_anomaly ORDER BY anomaly_score, date, region LIMIT 10""",
    "top_per_series": f"""
        WITH {SCORED_EVENTS},
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY anomaly_score, event_id) AS INTEGER)
                     AS rank FROM scored)
        SELECT * FROM r WHERE rank <= 5""",
    "persistence": f"""
        WITH {SCORED_EVENTS}
        SELECT event_id, ts, is_anomaly, {_count(_TIME)} AS anomaly_count_window,
               {_count(_TIME)} > 1 AS persistent_anomaly
        FROM scored""",
    "persistence_by_user": f"""
        WITH {SCORED_EVENTS}
        SELECT event_id, ts, user_id, is_anomaly, {_count('PARTITION BY user_id ' + _TIME)} AS anomaly_count_window,
               {_count('PARTITION BY user_id ' + _TIME)} > 1 AS persistent_anomaly
        FROM scored""",
    "persistence_rate": f"""
        WITH {SCORED_EVENTS}, p AS (SELECT is_anomaly, {_count(_TIME)} > 1 AS persistent FROM scored)
        SELECT count(*) FILTER (is_anomaly) AS total_anomalies, count(*) FILTER (persistent) AS persistent_anomalies,
               round(count(*) FILTER (persistent) * 1.0 / count(*) FILTER (is_anomaly), 6) AS persistence_rate
        FROM p""",
    "flag_rate": f"""
        WITH {SCORED_DAILY}
        SELECT count(*) AS rows, count(*) FILTER (is_anomaly) AS anomalies,
               round(avg(CAST(is_anomaly AS INTEGER)), 6) AS anomaly_rate
        FROM scored""",
    "seasonal_anomaly_rates": f"""
        WITH {SCORED_DAILY},
        g AS (SELECT month(date) AS m, quarter(date) AS q, CAST(is_anomaly AS INTEGER) AS f FROM scored)
        SELECT CASE WHEN m IS NOT NULL THEN 'month' ELSE 'quarter' END AS grain,
               CAST(coalesce(m, q) AS INTEGER) AS key, CAST(sum(f) AS BIGINT) AS sum, count(f) AS count,
               round(avg(f), 6) AS mean
        FROM g GROUP BY GROUPING SETS ((m), (q))""",
    "stability_metrics": f"""
        WITH {SCORED_EVENTS},
        c AS (SELECT anomaly_score,
                     stddev_samp(anomaly_score) OVER ({_TIME} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
                     / avg(anomaly_score) OVER ({_TIME} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS cv
              FROM scored)
        SELECT round(avg(anomaly_score), 6) AS mean_score, round(stddev_samp(anomaly_score), 6) AS std_score,
               round(avg(cv), 6) AS cv_mean, round(stddev_samp(cv), 6) AS cv_std,
               round(max(anomaly_score) - min(anomaly_score), 6) AS score_range
        FROM c""",
    "anomaly_overlay": f"""
        WITH {SCORED_DAILY}
        SELECT region, date, is_anomaly, 'orders' AS metric, CAST(orders AS DOUBLE) AS value FROM scored
        UNION ALL SELECT region, date, is_anomaly, 'revenue', revenue FROM scored""",
    "score_series": f"""
        WITH {SCORED_EVENTS}
        SELECT event_id, ts, anomaly_score AS score, CAST(-0.6 AS DOUBLE) AS threshold FROM scored""",
    "monthly_anomaly_rate": f"""
        WITH {SCORED_DAILY}
        SELECT CAST(month(date) AS INTEGER) AS month, round(avg(CAST(is_anomaly AS INTEGER)), 6) AS anomaly_rate
        FROM scored GROUP BY 1""",
    "anomaly_runs": _runs("", _TIME),
    "anomaly_runs_by_user": _runs("user_id", "PARTITION BY user_id " + _TIME),
    "anomaly_windows_ranked": f"""
        SELECT *, CAST(row_number() OVER (ORDER BY worst_score, run_length DESC, run_start, user_id) AS INTEGER) AS rank
        FROM ({_runs("user_id", "PARTITION BY user_id " + _TIME)}) ORDER BY rank LIMIT 20""",
    "prior_year_month": f"""
        WITH {REGION_DAILY},
        m AS (SELECT region, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                     sum(orders) AS s, count(orders) AS n FROM region_daily GROUP BY 1, 2, 3)
        SELECT region, year, month, round(s / n, 6) AS month_mean,
               round(sum(s) OVER (PARTITION BY region, month ORDER BY year
                                  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     / sum(n) OVER (PARTITION BY region, month ORDER BY year
                                    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS prior_mean
        FROM m""",
}
