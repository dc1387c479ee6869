"""Feature queries. Those on raw events run over one global order and always take the block layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.calendar import calendar_parts, cyclical_parts
from tidewatch.functions.columns import feature_columns
from tidewatch.functions.missing import column_means, drop_incomplete, impute
from tidewatch.operators.evaluation import rolling_cv
from tidewatch.operators.features import difference_features, engineer_features, lag_features, rolling_features
from tidewatch.operators.ordered import DAILY, SPREAD
from tidewatch.plans.catalog.shared import GAPPY, REGION_DAILY, rounded
from tidewatch.sources.series import gappy_events, region_daily, table
from tidewatch.sources.staging import staging_path
from tidewatch.streaming.incremental import feature_stream, features_of
from tidewatch.streaming.monitor import read_parquet_stream

_BY_REGION = {"order_by": ["date"], "partition_by": ["region"], "layout": DAILY}
_BY_TYPE = {"order_by": ["ts", "event_id"], "partition_by": ["event_type"]}
_GLOBAL = {"order_by": ["ts", "event_id"], "layout": SPREAD}
_CONFIG = {"features": {"rolling_windows": [7, 14, 30], "lag_features": [1, 7, 30], "seasonal_features": True}}
_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _events(spark, folder):
    return table(spark, folder, "events").select("event_id", "ts", "event_type", "value")


def _gappy(spark, folder):
    return gappy_events(spark, folder).select("event_id", "ts", "event_type", "reading")


def _calendar(spark, folder, parts):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return rounded(orders.withColumns(parts(F.col("o_orderdate"))))


def _engineered(spark, folder):
    return engineer_features(region_daily(spark, folder), _CONFIG, order_by=["date"], partition_by=["region"], layout=DAILY)


def _engineered_global(spark, folder):
    events = gappy_events(spark, folder).select("event_id", F.col("ts").alias("date"), "reading")
    return engineer_features(events, _CONFIG, order_by=["date", "event_id"], layout=SPREAD)


def _matrix(spark, folder):
    features = _engineered(spark, folder)
    return rounded(features.select("date", "region", *feature_columns(features)))


def _impute(spark, folder):
    gappy = _gappy(spark, folder)
    return rounded(impute(gappy, column_means(gappy, ["reading"])))


def _streamed(spark, folder):
    """Features of every event type computed as the events arrive."""
    schema = table(spark, folder, "events").schema
    stream = read_parquet_stream(spark, f"{folder}/events.parquet", schema)
    base = staging_path(spark, "stream")
    query = feature_stream(
        stream.select("event_id", "ts", "event_type", "value"),
        {"features": {"rolling_windows": [7], "lag_features": [1, 7]}},
        ["value"],
        **_BY_TYPE,
        target=base,
        checkpoint=f"{base}/checkpoint",
        available_now=True,
    )
    query.awaitTermination()
    return rounded(features_of(spark, base))


def _streamed_by_user(spark, folder):
    """Features of every user, whose events are few, as the events arrive in several batches."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    base = staging_path(spark, "user-stream")
    first, last = events.select(F.min("ts"), F.max("ts")).first()
    quarter = (last - first) / 4
    # Four arrivals, one after the other in order of time, so that no row comes late; the state outlives the query.
    for k in range(4):
        part = events.where(F.col("ts") >= F.lit(first + k * quarter))
        if k < 3:
            part = part.where(F.col("ts") < F.lit(first + (k + 1) * quarter))
        part.write.mode("append").parquet(f"{base}/arriving")
        query = feature_stream(
            read_parquet_stream(spark, f"{base}/arriving", events.schema),
            {"features": {"rolling_windows": [7], "lag_features": [1, 7]}},
            ["value"],
            order_by=["ts", "event_id"],
            partition_by=["user_id"],
            target=base,
            checkpoint=f"{base}/checkpoint",
            available_now=True,
            layout=DAILY,
        )
        query.awaitTermination()
    return rounded(features_of(spark, base))


QUERIES = {
    "rolling_stats_partitioned": lambda s, d: rounded(
        rolling_features(region_daily(s, d), ["orders", "revenue"], [7, 30], **_BY_REGION)
    ),
    "rolling_stats_global": lambda s, d: rounded(rolling_features(_events(s, d), ["value"], [7, 30], **_GLOBAL)),
    # Full windows: means of, say, 160 amounts in cents lie right between two numbers of six digits.
    "rolling_stats_wide": lambda s, d: rounded(
        rolling_features(_events(s, d), ["value"], [300, 2500], min_periods=None, **_GLOBAL)
    ),
    "rolling_min_periods": lambda s, d: rounded(
        rolling_features(_gappy(s, d), ["reading"], [7], min_periods=5, **_GLOBAL)
    ),
    "rolling_full_windows": lambda s, d: rounded(
        rolling_features(_gappy(s, d), ["reading"], [14], min_periods=None, **_BY_TYPE)
    ),
    "rolling_cv": lambda s, d: rounded(rolling_cv(_events(s, d), "value", 30, **_GLOBAL)),
    "lag_features": lambda s, d: lag_features(region_daily(s, d), ["orders", "revenue"], [1, 7, 30], **_BY_REGION),
    "lag_features_global": lambda s, d: lag_features(_events(s, d), ["value"], [1, 7, 30], **_GLOBAL),
    "lead_features": lambda s, d: lag_features(_events(s, d), ["value"], [-1, -7], **_GLOBAL),
    "diff_features": lambda s, d: rounded(
        difference_features(region_daily(s, d), ["orders", "revenue"], [1, 7], **_BY_REGION)
    ),
    "pct_change_pad": lambda s, d: rounded(difference_features(_gappy(s, d), ["reading"], [1, 3], **_GLOBAL)),
    "pct_change_pad_by_type": lambda s, d: rounded(
        difference_features(_gappy(s, d), ["reading"], [1], **{**_BY_TYPE, "layout": SPREAD})
    ),
    "pct_change_nofill": lambda s, d: rounded(
        difference_features(_gappy(s, d), ["reading"], [1], fill="none", **_BY_TYPE)
    ),
    "seasonal_parts": lambda s, d: _calendar(s, d, calendar_parts),
    "seasonal_cyclical": lambda s, d: _calendar(s, d, cyclical_parts),
    "engineered_features": lambda s, d: rounded(_engineered(s, d)),
    "engineered_features_global": lambda s, d: rounded(_engineered_global(s, d)),
    "feature_matrix": _matrix,
    "mean_impute": _impute,
    "stream_features": _streamed,
    "stream_features_by_user": _streamed_by_user,
    "complete_rows": lambda s, d: drop_incomplete(gappy_events(s, d)),
}


def _rolling(col: str, windows, over: str, needed=lambda w: 1) -> list[str]:
    out = []
    for w in windows:
        frame = f"OVER ({over} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for stat, function in _STATS.items():
            rolled = f"{function}({col}) {frame}"
            if needed(w) > 1:
                rolled = f"CASE WHEN count({col}) {frame} >= {needed(w)} THEN {rolled} END"
            out.append(f"{_round(rolled, col, stat)} AS {col}_rolling_{stat}_{w}")
    return out


def _round(expression: str, col: str, stat: str) -> str:
    return expression if col == "orders" and stat in ("min", "max") else f"round({expression}, 6)"


def _lags(col: str, lags, over: str) -> list[str]:
    return [f"lag({col}, {n}) OVER ({over}) AS {col}_lag_{n}" for n in lags]


def _ratio(current: str, previous: str) -> str:
    return (
        f"CASE WHEN {previous} = 0 THEN CASE WHEN {current} > 0 THEN CAST('inf' AS DOUBLE)"
        f" WHEN {current} < 0 THEN CAST('-inf' AS DOUBLE) END ELSE {current} / {previous} - 1 END"
    )


def _differences(col: str, periods, over: str, filled: str) -> list[str]:
    out = []
    for p in periods:
        difference = f"{col} - lag({col}, {p}) OVER ({over})"
        out.append(f"{difference if col == 'orders' else f'round({difference}, 6)'} AS {col}_diff_{p}")
        out.append(f"round({_ratio(filled, f'lag({filled}, {p}) OVER ({over})')}, 6) AS {col}_pct_change_{p}")
    return out


def _padded(source: str, columns, over: str) -> str:
    filled = [
        f"last_value({c} IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}_f"
        for c in columns
    ]
    return f"padded AS (SELECT *, {', '.join(filled)} FROM {source})"


def _parts(date: str) -> list[str]:
    fields = {
        "year": f"year({date})",
        "month": f"month({date})",
        "day": f"day({date})",
        "day_of_week": f"isodow({date}) - 1",
        "day_of_year": f"dayofyear({date})",
        "quarter": f"quarter({date})",
        "week_of_year": f"week({date})",
    }
    return [f"CAST({e} AS INTEGER) AS {n}" for n, e in fields.items()]


def _cycles(date: str) -> list[str]:
    month, weekday = f"month({date}) * 2 * pi() / 12", f"(isodow({date}) - 1) * 2 * pi() / 7"
    return [
        f"round(sin({month}), 6) AS month_sin",
        f"round(cos({month}), 6) AS month_cos",
        f"round(sin({weekday}), 6) AS dow_sin",
        f"round(cos({weekday}), 6) AS dow_cos",
    ]


_REGION = "PARTITION BY region ORDER BY date NULLS LAST"
_TYPE = "PARTITION BY event_type ORDER BY ts NULLS LAST, event_id"
_USER = "PARTITION BY user_id ORDER BY ts NULLS LAST, event_id"
_TIME = "ORDER BY ts NULLS LAST, event_id"


def _all_features(columns, over: str) -> list[str]:
    out = []
    for c in columns:
        out += _rolling(c, [7, 14, 30], over)
        out += _lags(c, [1, 7, 30], over)
        out += _differences(c, [1], over, f"{c}_f")
    return out


def _select(columns: list[str], source: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} SELECT {', '.join(columns)} FROM {source}"


_DAILY_COLUMNS = ["date", "region", "orders", "revenue"]
_EVENT_COLUMNS = ["event_id", "ts", "event_type", "round(value, 6) AS value"]
_GAPPY_COLUMNS = ["event_id", "ts", "event_type", "round(reading, 6) AS reading"]
_EVENTS = "e AS (SELECT event_id, ts, event_type, value FROM events)"
_ENGINEERED = _all_features(["orders", "revenue"], _REGION)
_GLOBAL_EVENTS = "g AS (SELECT event_id, ts AS date, reading FROM gappy)"
_DATE_ORDER = "ORDER BY date NULLS LAST, event_id"

SQL = {
    "rolling_stats_partitioned": _select(
        _DAILY_COLUMNS + _rolling("orders", [7, 30], _REGION) + _rolling("revenue", [7, 30], _REGION),
        "region_daily",
        REGION_DAILY,
    ),
    "rolling_stats_global": _select(_EVENT_COLUMNS + _rolling("value", [7, 30], _TIME), "e", _EVENTS),
    "rolling_stats_wide": _select(_EVENT_COLUMNS + _rolling("value", [300, 2500], _TIME, lambda w: w), "e", _EVENTS),
    "rolling_min_periods": _select(_GAPPY_COLUMNS + _rolling("reading", [7], _TIME, lambda w: 5), "gappy", GAPPY),
    "rolling_full_windows": _select(_GAPPY_COLUMNS + _rolling("reading", [14], _TYPE, lambda w: w), "gappy", GAPPY),
    "rolling_cv": _select(
        _EVENT_COLUMNS
        + [
            f"round(stddev_samp(value) OVER ({_TIME} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
            f" / avg(value) OVER ({_TIME} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS value_rolling_cv_30"
        ],
        "e",
        _EVENTS,
    ),
    "lag_features": _select(
        _DAILY_COLUMNS + _lags("orders", [1, 7, 30], _REGION) + _lags("revenue", [1, 7, 30], _REGION),
        "region_daily",
        REGION_DAILY,
    ),
    "lag_features_global": _select(_EVENT_COLUMNS + _lags("value", [1, 7, 30], _TIME), "e", _EVENTS),
    "lead_features": _select(
        _EVENT_COLUMNS + [f'lead(value, {n}) OVER ({_TIME}) AS "value_lag_-{n}"' for n in (1, 7)], "e", _EVENTS
    ),
    "diff_features": _select(
        _DAILY_COLUMNS
        + _differences("orders", [1, 7], _REGION, "orders_f")
        + _differences("revenue", [1, 7], _REGION, "revenue_f"),
        "padded",
        REGION_DAILY,
        _padded("region_daily", ["orders", "revenue"], _REGION),
    ),
    "pct_change_pad": _select(
        _GAPPY_COLUMNS + _differences("reading", [1, 3], _TIME, "reading_f"),
        "padded",
        GAPPY,
        _padded("gappy", ["reading"], _TIME),
    ),
    "pct_change_pad_by_type": _select(
        _GAPPY_COLUMNS + _differences("reading", [1], _TYPE, "reading_f"),
        "padded",
        GAPPY,
        _padded("gappy", ["reading"], _TYPE),
    ),
    "pct_change_nofill": _select(_GAPPY_COLUMNS + _differences("reading", [1], _TYPE, "reading"), "gappy", GAPPY),
    "seasonal_parts": f"SELECT o_orderkey, o_orderdate, {', '.join(_parts('o_orderdate'))} FROM orders",
    "seasonal_cyclical": f"SELECT o_orderkey, o_orderdate, {', '.join(_cycles('o_orderdate'))} FROM orders",
    "engineered_features": _select(
        _DAILY_COLUMNS + _parts("date") + _cycles("date") + _ENGINEERED,
        "padded",
        REGION_DAILY,
        _padded("region_daily", ["orders", "revenue"], _REGION),
    ),
    "engineered_features_global": _select(
        ["event_id", "date", "round(reading, 6) AS reading"]
        + _parts("date")
        + _cycles("date")
        + _all_features(["reading"], _DATE_ORDER),
        "padded",
        GAPPY,
        _GLOBAL_EVENTS,
        _padded("g", ["reading"], _DATE_ORDER),
    ),
    "feature_matrix": _select(
        _DAILY_COLUMNS + _cycles("date") + _ENGINEERED,
        "padded",
        REGION_DAILY,
        _padded("region_daily", ["orders", "revenue"], _REGION),
    ),
    "mean_impute": f"""
        WITH {GAPPY}
        SELECT event_id, ts, event_type, round(coalesce(reading, avg(reading) OVER ()), 6) AS reading FROM gappy""",
    "stream_features": _select(
        _EVENT_COLUMNS
        + _rolling("value", [7], _TYPE)
        + _lags("value", [1, 7], _TYPE)
        + _differences("value", [1], _TYPE, "value_f"),
        "padded",
        _EVENTS,
        _padded("e", ["value"], _TYPE),
    ),
    "stream_features_by_user": _select(
        ["event_id", "ts", "user_id", "round(value, 6) AS value"]
        + _rolling("value", [7], _USER)
        + _lags("value", [1, 7], _USER)
        + _differences("value", [1], _USER, "value_f"),
        "padded",
        "e AS (SELECT event_id, ts, user_id, value FROM events)",
        _padded("e", ["value"], _USER),
    ),
    "complete_rows": f"WITH {GAPPY} SELECT * FROM gappy WHERE date IS NOT NULL AND reading IS NOT NULL",
}
