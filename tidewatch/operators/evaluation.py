"""Evaluation of anomaly flags and scores without labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import parse_date
from tidewatch.functions.missing import divide, value
from tidewatch.operators.ordered import Frame, Layout, over_rows
from tidewatch.operators.wide import WIDE, wide_count, wide_extremes, wide_moments
from tidewatch.operators.ranking import top_anomalies, top_per_series

STABILITY_WINDOW = 30


def _persistence_columns(frame: Frame, anomaly_col: str, window: int) -> dict[str, Column]:
    flag = F.col(anomaly_col).cast("int")
    if window > WIDE:
        count = wide_count(frame, flag, [window])[window]
    else:
        count = F.coalesce(frame.once(F.sum(flag).over(frame.rows(window - 1))), F.lit(0).cast("long"))
    return {"anomaly_count_window": count, "persistent_anomaly": count > 1}


def _cv_column(frame: Frame, score: Column, window: int) -> Column:
    if window > WIDE:
        _, mean, std = wide_moments(frame, score, [window], wide_extremes(frame, score, [window]))[window]
        return divide(std, mean)
    rows = frame.rows(window - 1)
    return divide(frame.once(F.stddev_samp(score).over(rows)), frame.once(F.avg(score).over(rows)))


def anomaly_persistence(
    df: DataFrame,
    anomaly_col: str = "is_anomaly",
    window: int = 7,
    *,
    order_by: Sequence[str] = ("date",),
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> DataFrame:
    """Add the number of anomalies in the last ``window`` rows and whether there is more than one."""
    return over_rows(
        df,
        lambda frame: _persistence_columns(frame, anomaly_col, window),
        order_by=order_by,
        partition_by=partition_by,
        lookback=window - 1,
        layout=layout,
    )


def persistence_rate(df: DataFrame, anomaly_col: str = "is_anomaly") -> DataFrame:
    """Totals of an ``anomaly_persistence`` result; the rate is missing when nothing is flagged."""
    total, persistent = F.count_if(F.col(anomaly_col)), F.count_if(F.col("persistent_anomaly"))
    return df.agg(
        total.alias("total_anomalies"),
        persistent.alias("persistent_anomalies"),
        F.try_divide(persistent, total).alias("persistence_rate"),
    )


def flag_rate(df: DataFrame, anomaly_col: str = "is_anomaly") -> DataFrame:
    """Rows, flagged rows and their share."""
    flag = F.col(anomaly_col)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(flag).alias("anomalies"),
        F.avg(flag.cast("int")).alias("anomaly_rate"),
    )


def seasonal_distribution(df: DataFrame, date_col: str = "date", anomaly_col: str = "is_anomaly") -> DataFrame:
    """Flag sum, count and mean per month and per quarter in one pass, as (grain, key, sum, count, mean)."""
    typed = parse_date(df, date_col).where(F.col(date_col).isNotNull())
    keyed = typed.select(
        F.month(date_col).alias("month"), F.quarter(date_col).alias("quarter"), F.col(anomaly_col).alias("flag")
    )
    # A month fixes its quarter: aggregate the rows once by month, the twelve partial results again by quarter.
    monthly = keyed.groupBy("month", "quarter").agg(
        F.sum(F.col("flag").cast("int")).alias("sum"), F.count("flag").alias("count")
    )
    grains = monthly.groupingSets([["month"], ["quarter"]], "month", "quarter").agg(
        F.sum("sum").alias("sum"), F.sum("count").alias("count")
    )
    by_month = F.col("month").isNotNull()
    return grains.select(
        F.when(by_month, "month").otherwise("quarter").alias("grain"),
        F.coalesce("month", "quarter").alias("key"),
        "sum",
        "count",
        F.try_divide(F.col("sum"), F.col("count")).alias("mean"),
    )


def stability_metrics(
    df: DataFrame,
    score_col: str = "anomaly_score",
    window: int = STABILITY_WINDOW,
    *,
    order_by: Sequence[str] = ("date",),
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> DataFrame:
    """Mean, deviation and range of the score, and of its rolling coefficient of variation, as one row."""
    slim = df.select(*dict.fromkeys([*partition_by, *order_by, score_col]))
    with_cv = rolling_cv(slim, score_col, window, order_by=order_by, partition_by=partition_by, layout=layout)
    return _stability(with_cv, value(df, score_col), F.col(f"{score_col}_rolling_cv_{window}"))


def _stability(df: DataFrame, score: Column, cv: Column) -> DataFrame:
    return df.agg(
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("std_score"),
        F.avg(cv).alias("cv_mean"),
        F.stddev_samp(cv).alias("cv_std"),
        (F.max(score) - F.min(score)).alias("score_range"),
    )


def rolling_cv(
    df: DataFrame,
    column: str,
    window: int,
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> DataFrame:
    """Rolling sample standard deviation over rolling mean."""
    return over_rows(
        df,
        lambda frame: {f"{column}_rolling_cv_{window}": _cv_column(frame, value(df, column), window)},
        order_by=order_by,
        partition_by=partition_by,
        lookback=window - 1,
        layout=layout,
    )


def evaluate_anomalies(
    df: DataFrame,
    config: dict,
    *,
    date_col: str = "date",
    anomaly_col: str = "is_anomaly",
    score_col: str = "anomaly_score",
    order_by: Sequence[str] = ("date",),
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> dict[str, DataFrame]:
    """All evaluation tables by name. Persistence and stability share one ordered pass."""
    settings = config.get("evaluation") or {}
    persistence_window = settings.get("persistence_window", 7)
    ordered = over_rows(
        df,
        lambda frame: {
            **_persistence_columns(frame, anomaly_col, persistence_window),
            "__cv": _cv_column(frame, value(df, score_col), STABILITY_WINDOW),
        },
        order_by=order_by,
        partition_by=partition_by,
        lookback=max(persistence_window, STABILITY_WINDOW) - 1,
        layout=layout,
    )
    top_k = settings.get("top_k_anomalies", 20)
    results = {
        "persistence": ordered.drop("__cv"),
        "top_anomalies": top_anomalies(df, score_col, top_k, tiebreak=[*order_by, *partition_by]),
    }
    if settings.get("seasonality_check", True):
        results["seasonality"] = seasonal_distribution(df, date_col, anomaly_col)
    results["stability"] = _stability(ordered, value(df, score_col), F.col("__cv"))
    return results


def anomaly_runs(
    df: DataFrame,
    anomaly_col: str = "is_anomaly",
    score_col: str = "anomaly_score",
    *,
    order_by: Sequence[str] = ("date",),
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> DataFrame:
    """Runs of consecutive flagged rows: first and last order key, length and most severe score.

    The flagged rows of one run share the last unflagged row in front of them, which is therefore the run's key; no
    running count over the series is needed.
    """
    flagged = F.coalesce(F.col(anomaly_col), F.lit(False))
    position = F.struct(*[F.col(f"`{c}`") for c in order_by])
    slim = df.select(*dict.fromkeys([*partition_by, *order_by, anomaly_col, score_col]))
    keyed = over_rows(
        slim,
        lambda frame: {"__run": frame.filled("calm")},
        order_by=order_by,
        partition_by=partition_by,
        fill={"calm": F.when(~flagged, position)},
        layout=layout,
    )
    first = order_by[0]
    runs = keyed.where(flagged).groupBy(*partition_by, "__run")
    return runs.agg(
        F.min(first).alias("run_start"),
        F.max(first).alias("run_end"),
        F.count("*").alias("run_length"),
        F.min(value(slim, score_col)).alias("worst_score"),
    ).drop("__run")


def ranked_runs(runs: DataFrame, k: int = 20, *, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most severe runs of ``anomaly_runs`` with their rank: worst score first, then the longest, then the
    earliest. Every task keeps ``k`` rows before any is moved."""
    order = [F.col("worst_score").asc_nulls_last(), F.col("run_length").desc(), F.col("run_start").asc()]
    top = runs.orderBy(*order, *tiebreak).limit(k)
    # At most k rows are left.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order, *tiebreak)))


def prior_years_month_mean(
    df: DataFrame, value_col: str, *, date_col: str = "date", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Mean per series, year and month next to the mean of the same month over all earlier years.

    The rows are aggregated to months first; the window then sees twelve rows per series and year.
    """
    typed = parse_date(df, date_col).where(F.col(date_col).isNotNull())
    x = value(df, value_col)
    monthly = typed.groupBy(*partition_by, F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(
        F.sum(x).alias("__sum"), F.count(x).alias("__count")
    )
    earlier = Window.partitionBy(*partition_by, "month").orderBy("year").rangeBetween(Window.unboundedPreceding, -1)
    return monthly.select(
        *partition_by,
        "year",
        "month",
        F.try_divide(F.col("__sum"), F.col("__count")).alias("month_mean"),
        F.try_divide(F.sum("__sum").over(earlier), F.sum("__count").over(earlier)).alias("prior_mean"),
    )


def method_overlap(df: DataFrame, first: str, second: str) -> DataFrame:
    """Agreement of two boolean flags on the same rows: counts, share of overlap and disagreements."""
    a, b = F.coalesce(F.col(first), F.lit(False)), F.coalesce(F.col(second), F.lit(False))
    both, either = F.count_if(a & b), F.count_if(a | b)
    return df.agg(
        F.count_if(a).alias("first_flags"),
        F.count_if(b).alias("second_flags"),
        both.alias("both"),
        F.count_if(a & ~b).alias("only_first"),
        F.count_if(b & ~a).alias("only_second"),
        F.try_divide(both, either).alias("overlap"),
    )


def join_methods(
    first: DataFrame, second: DataFrame, keys: Sequence[str], *, anomaly_col: str = "is_anomaly"
) -> DataFrame:
    """Flags of two detectors side by side by row key; a row only one of them scored stays, with a null.

    Both sides are stacked and aggregated by key, so a key that is not unique or missing stays one row: its flag is true
    if any of its rows has one, and ``first_rows`` and ``second_rows`` say how many rows there were.
    """
    none = F.lit(None).cast("boolean")
    left = first.select(*keys, F.col(anomaly_col).alias("first_flag"), none.alias("second_flag"), F.lit(1).alias("__side"))
    right = second.select(*keys, none.alias("first_flag"), F.col(anomaly_col).alias("second_flag"), F.lit(2).alias("__side"))
    return (
        left.union(right)
        .groupBy(*keys)
        .agg(
            F.bool_or("first_flag").alias("first_flag"),
            F.bool_or("second_flag").alias("second_flag"),
            F.count_if(F.col("__side") == 1).alias("first_rows"),
            F.count_if(F.col("__side") == 2).alias("second_rows"),
        )
    )


def top_per_method(df: DataFrame, methods: dict[str, tuple[str, str]], k: int, *, keys: Sequence[str]) -> DataFrame:
    """(method, rank, keys, score): the ``k`` most severe flagged rows of every method, which is given as its score column
    and its flag column; lower scores are more severe.

    One scan for all methods: every task keeps ``k`` rows of each before any is moved.
    """
    each = F.array(
        *[
            F.struct(F.lit(m).alias("method"), value(df, score).cast("double").alias("score"), F.col(flag).alias("flag"))
            for m, (score, flag) in methods.items()
        ]
    )
    flagged = df.select(*keys, F.explode(each).alias("__m")).where("__m.flag").select(*keys, "__m.method", "__m.score")
    return top_per_series(flagged, "score", k, partition_by=["method"], tiebreak=keys)


def method_disagreements(
    df: DataFrame, first: tuple[str, str], second: tuple[str, str], k: int, *, keys: Sequence[str]
) -> DataFrame:
    """(side, rank, keys, score): the ``k`` most severe rows that only the first and that only the second method flags, by
    the score of the method that flags them."""
    a, b = (F.coalesce(F.col(flag), F.lit(False)) for _, flag in (first, second))
    score = F.when(a, value(df, first[0]).cast("double")).otherwise(value(df, second[0]).cast("double"))
    side = F.when(a & ~b, "only_first").when(b & ~a, "only_second")
    apart = df.select(*keys, side.alias("side"), score.alias("score")).where("side IS NOT NULL")
    return top_per_series(apart, "score", k, partition_by=["side"], tiebreak=keys)
