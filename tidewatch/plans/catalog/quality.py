"""Quality-check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.outliers import detect_outliers, outlier_summary
from tidewatch.operators.quality import (
    check_seasonality,
    configured_bounds,
    date_extent,
    date_summary,
    discovered_bounds,
    groups_with_missing_dates,
    missing_ratios,
    numeric_bounds,
    quality_table,
    summary_stats,
    table_profile,
)
from tidewatch.plans.catalog.shared import GAPPY, REGION_DAILY, rounded
from tidewatch.plans.quality_run import run_quality_checks
from tidewatch.sources.series import gappy_events, region_daily, table

_LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_BOUNDS = {"l_quantity": {"min": 3, "max": 40}, "l_extendedprice": {"max": 50000.0}, "absent": {"min": 0}}
_REPORT_CONFIG = {
    "qc": {
        "required_columns": ["date", "event_type"],
        "date_monotonic_group_by": ["event_type"],
        "numeric_bounds": {"reading": {"min": 0.5, "max": 100}},
        "missing_threshold": 0.15,
    },
    "date_range": {"start": "2024-01-02", "end": "2024-01-20"},
}


def _beds(spark, folder):
    """Shipments under names that carry built-in bounds."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") - 10).alias("icu_beds_used"),
        (F.col("l_extendedprice") / 500).alias("fill_rate"),
        (F.col("l_discount") * 14 - 0.2).alias("occupancy_share"),
        (F.col("l_tax") * 100 - 2).alias("occupancy_percent"),
        F.col("l_returnflag").alias("occupancy_code"),
    )


def _date_range(spark, folder):
    orders = table(spark, folder, "orders")
    extent = date_extent(orders, "o_orderdate")
    low, high = F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("2001-12-31").cast("timestamp_ntz")
    return extent.withColumn("covered", (F.col("first_date") <= low) & (F.col("last_date") >= high))


def _iqr(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return detect_outliers(events, ["value"], "iqr", 1.5)


def _full_report(spark, folder):
    tables = {"events": gappy_events(spark, folder), "orders": table(spark, folder, "orders")}
    config = {"qc": {"fail_fast": False, "fail_on_missing_threshold": True, "missing_threshold": 0.15}}
    result = run_quality_checks(spark, tables, config)
    report = result.report.groupBy("dataset_id").agg(
        F.count_if(~F.col("passed")).alias("failed_checks"), F.count("passed").alias("judged_checks")
    )
    verdicts = spark.createDataFrame(list(result.status.items()), "dataset_id string, status string")
    return report.join(verdicts, "dataset_id")


QUERIES = {
    "numeric_profile": lambda s, d: rounded(
        table(s, d, "lineitem").agg(
            F.count("*").alias("row_count"),
            *[
                f(c).alias(f"{c}_{n}")
                for c in _LINE_METRICS
                for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))
            ],
        ),
        4,
    ),
    "table_profile": lambda s, d: table_profile(table(s, d, "lineitem")).withColumn(
        "columns", F.array_join("columns", ",")
    ),
    "summary_stats": lambda s, d: rounded(summary_stats(table(s, d, "lineitem"), _LINE_METRICS), 4),
    # Small enough a buffer that the narrowing search does the work.
    "summary_stats_spread": lambda s, d: rounded(
        summary_stats(table(s, d, "lineitem"), _LINE_METRICS, exact_rows=1000), 4
    ),
    "date_summary": lambda s, d: date_summary(table(s, d, "orders"), "o_orderdate").withColumn(
        "mean", F.date_trunc("second", "mean").cast("timestamp_ntz")
    ),
    "qc_missingness": lambda s, d: rounded(missing_ratios(gappy_events(s, d))),
    "qc_bounds": lambda s, d: rounded(
        numeric_bounds(table(s, d, "lineitem"), configured_bounds(table(s, d, "lineitem"), _BOUNDS))
    ),
    "qc_auto_bounds": lambda s, d: rounded(numeric_bounds(_beds(s, d), discovered_bounds(_beds(s, d)))),
    "qc_null_dates_by_group": lambda s, d: groups_with_missing_dates(
        gappy_events(s, d), "date", ["event_type", "user_id"]
    ),
    "qc_date_range": _date_range,
    "qc_report": lambda s, d: rounded(quality_table(gappy_events(s, d), "events", _REPORT_CONFIG)),
    "qc_verdicts": _full_report,
    "outliers_zscore": lambda s, d: detect_outliers(
        table(s, d, "events").select("event_id", "value"), ["value"], "zscore", 3.0
    ),
    "outliers_iqr": _iqr,
    "outlier_summary": lambda s, d: outlier_summary(table(s, d, "lineitem"), 1.5, _LINE_METRICS),
    "seasonality_profile": lambda s, d: rounded(check_seasonality(region_daily(s, d), "date", "revenue"), 4),
}


def _union(parts: list[str], *ctes: str) -> str:
    head = f"WITH {', '.join(ctes)} " if ctes else ""
    return head + " UNION ALL ".join(parts)


def _stats(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean,"
        f" round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,"
        + "".join(f" round(quantile_cont({c}, {q}), 4) AS {n}," for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
        + f" round(max({c}), 4) AS max FROM lineitem"
    )


def _violation(source: str, column: str, kind: str, bound: float) -> str:
    broken = f"{column} {'<' if kind == 'below_minimum' else '>'} {bound}"
    return (
        f"SELECT '{column}' AS \"column\", '{kind}' AS type, CAST({bound} AS DOUBLE) AS bound,"
        f" count(*) FILTER ({broken}) AS count,"
        f" round(count(*) FILTER ({broken}) * 100.0 / count(*), 6) AS percentage FROM {source}"
        f" HAVING count(*) FILTER ({broken}) > 0"
    )


_BEDS = """beds AS (
  SELECT l_quantity - 10 AS icu_beds_used, l_extendedprice / 500 AS fill_rate, l_discount * 14 - 0.2 AS occupancy_share
  FROM lineitem)"""


def _check(check: str, column: str | None, metric: str, bound: float | None, measured: str, passed: str) -> str:
    named = "NULL" if column is None else f"'{column}'"
    limit = "NULL" if bound is None else str(bound)
    return (
        f"SELECT 'events' AS dataset_id, '{check}' AS \"check\", CAST({named} AS VARCHAR) AS \"column\","
        f" '{metric}' AS metric, CAST({limit} AS DOUBLE) AS bound, round(CAST({measured} AS DOUBLE), 6) AS value,"
        f" CAST({passed} AS BOOLEAN) AS passed FROM gappy"
    )


def _report_sql() -> str:
    undated = "count(*) FILTER (date IS NULL AND event_type IS NOT NULL)"
    low, high = "count(*) FILTER (reading < 0.5)", "count(*) FILTER (reading > 100)"
    covered = "(min(date) <= TIMESTAMP '2024-01-02' AND max(date) >= TIMESTAMP '2024-01-20')"
    parts = [
        _check("profile", None, "row_count", None, "count(*)", "NULL"),
        _check("profile", None, "column_count", None, "max(6)", "NULL"),
        _check("required_columns", "date", "present", None, "max(1)", "max(1) = 1"),
        _check("required_columns", "event_type", "present", None, "max(1)", "max(1) = 1"),
        _check("date_monotonic", "date", "missing_dates", None, undated, f"{undated} = 0"),
    ]
    for c in ("event_id", "ts", "date", "event_type", "user_id", "reading"):
        ratio = f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)"
        parts.append(_check("missingness", c, "ratio", 0.15, ratio, f"{ratio} <= 0.15"))
    for kind, bound, count in (("below_minimum", 0.5, low), ("above_maximum", 100, high)):
        parts.append(_check("numeric_bounds", "reading", kind, bound, count, f"{count} = 0"))
        share = f"{count} * 100.0 / count(*)"
        parts.append(_check("numeric_bounds", "reading", f"{kind}_pct", bound, share, f"{count} = 0"))
    parts.append(_check("date_range", "date", "covered", None, f"CAST({covered} AS INTEGER)", covered))
    return _union(parts, GAPPY)


def _verdict_sql() -> str:
    def missing(columns, source):
        return [f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.15 FROM {source})" for c in columns]

    events = missing(["event_id", "ts", "date", "event_type", "user_id", "reading"], "gappy")
    over = " + ".join(f"CAST({m} AS BIGINT)" for m in events)
    undated = "CAST((SELECT count(*) FILTER (date IS NULL) > 0 FROM gappy) AS BIGINT)"
    # orders has no date column: that alone fails it; its six columns hold no missing values.
    return f"""
        WITH {GAPPY}
        SELECT 'events' AS dataset_id, {over} + {undated} AS failed_checks, CAST(1 + 1 + 6 AS BIGINT) AS judged_checks,
               CASE WHEN {over} > 0 THEN 'failed' ELSE 'passed' END AS status
        UNION ALL
        SELECT 'orders', CAST(1 AS BIGINT), CAST(1 + 6 AS BIGINT), 'failed' FROM orders HAVING count(*) > 0"""


SQL = {
    "numeric_profile": "SELECT count(*) AS row_count, "
    + ", ".join(
        f"round({f}({c}), 4) AS {c}_{n}"
        for c in _LINE_METRICS
        for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))
    )
    + " FROM lineitem",
    "table_profile": """
        SELECT count(*) AS row_count, 11 AS column_count,
               'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,'
               || 'l_returnflag,l_linestatus,l_shipdate' AS columns
        FROM lineitem""",
    "summary_stats": _union([_stats(c) for c in _LINE_METRICS]),
    "summary_stats_spread": _union([_stats(c) for c in _LINE_METRICS]),
    "date_summary": """
        WITH t AS (SELECT epoch_us(o_orderdate) AS t FROM orders)
        SELECT count(*) AS count, make_timestamp(min(t)) AS min,
               date_trunc('second', make_timestamp(CAST(round(avg(t)) AS BIGINT))) AS mean,
               make_timestamp(CAST(round(quantile_cont(CAST(t AS DOUBLE), 0.25)) AS BIGINT)) AS q25,
               make_timestamp(CAST(round(quantile_cont(CAST(t AS DOUBLE), 0.5)) AS BIGINT)) AS q50,
               make_timestamp(CAST(round(quantile_cont(CAST(t AS DOUBLE), 0.75)) AS BIGINT)) AS q75,
               make_timestamp(max(t)) AS max
        FROM t""",
    "qc_missingness": _union(
        [
            f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM gappy"
            for c in ("event_id", "ts", "date", "event_type", "user_id", "reading")
        ],
        GAPPY,
    ),
    "qc_bounds": _union(
        [
            _violation("lineitem", "l_quantity", "below_minimum", 3),
            _violation("lineitem", "l_quantity", "above_maximum", 40),
            _violation("lineitem", "l_extendedprice", "above_maximum", 50000),
        ]
    ),
    "qc_auto_bounds": _union(
        [
            _violation("beds", "icu_beds_used", "below_minimum", 0),
            _violation("beds", "fill_rate", "below_minimum", 0),
            _violation("beds", "fill_rate", "above_maximum", 100),
            _violation("beds", "occupancy_share", "below_minimum", 0),
            _violation("beds", "occupancy_share", "above_maximum", 1),
        ],
        _BEDS,
    ),
    "qc_null_dates_by_group": f"""
        WITH {GAPPY}
        SELECT event_type, user_id, count(*) AS missing_dates FROM gappy
        WHERE date IS NULL AND event_type IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2""",
    "qc_date_range": """
        SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
               min(o_orderdate) <= TIMESTAMP '1995-01-01' AND max(o_orderdate) >= TIMESTAMP '2001-12-31' AS covered
        FROM orders""",
    "qc_report": _report_sql(),
    "qc_verdicts": _verdict_sql(),
    "outliers_zscore": """
        SELECT event_id, value, coalesce(abs(value - avg(value) OVER ()) / stddev_samp(value) OVER () > 3, false)
               AS value_outlier
        FROM events""",
    "outliers_iqr": """
        WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
        SELECT event_id, value, value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS value_outlier
        FROM events, q""",
    "outlier_summary": _union(
        [
            f"SELECT '{c}' AS \"column\", count(*) FILTER (abs({c} - m) / s > 1.5) AS outliers"
            f" FROM lineitem, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM lineitem)"
            for c in _LINE_METRICS
        ]
    ),
    "seasonality_profile": f"""
        WITH {REGION_DAILY},
        m AS (SELECT CAST(month(date) AS INTEGER) AS month, avg(revenue) AS v FROM region_daily GROUP BY 1)
        SELECT round(stddev_samp(v) / avg(v), 4) AS coefficient_of_variation,
               arg_max(month, v) AS peak_month, arg_min(month, v) AS trough_month,
               round(max(v), 4) AS peak_value, round(min(v), 4) AS trough_value
        FROM m""",
}
