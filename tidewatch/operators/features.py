"""Time-series features: rolling statistics, lags, differences, relative changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.calendar import parse_date, seasonal_features
from tidewatch.functions.columns import metric_columns, present
from tidewatch.functions.missing import divide, is_floating, known, value
from tidewatch.operators.ordered import Frame, Layout, over_rows
from tidewatch.operators.wide import WIDE, wide_extremes, wide_moments

ROLLING_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling_columns(
    frame: Frame, name: str, col: Column, windows: Sequence[int], min_periods: int | None = 1
) -> dict[str, Column]:
    """Trailing statistics of the last ``w`` rows, missing while fewer than ``min_periods`` values are present."""
    out = {}
    wide = [w for w in windows if w > WIDE]
    extremes = wide_extremes(frame, col, wide) if wide else {}
    moments = wide_moments(frame, col, wide, extremes) if wide else {}
    for w in windows:
        rows = frame.rows(w - 1)
        needed = w if min_periods is None else min_periods
        if w > WIDE:
            count, mean, std = moments[w]
            low, high = extremes[w]
            for stat, rolled in {"mean": mean, "std": std, "min": low, "max": high}.items():
                out[f"{name}_rolling_{stat}_{w}"] = F.when(count >= needed, rolled) if needed > 1 else rolled
            continue
        enough = frame.once(F.count(col).over(rows)) >= needed if needed > 1 else None
        for stat, aggregate in ROLLING_STATS.items():
            rolled = aggregate(col).over(rows)
            if stat in ("mean", "std"):
                rolled = known(rolled)
            # Each statistic is already missing on an empty window.
            out[f"{name}_rolling_{stat}_{w}"] = rolled if enough is None else F.when(enough, rolled)
    return out


def lag_columns(frame: Frame, name: str, col: Column, lags: Sequence[int]) -> dict[str, Column]:
    return {f"{name}_lag_{n}": F.lag(col, n).over(frame.order) for n in lags}


def difference_columns(
    frame: Frame, name: str, col: Column, periods: Sequence[int], pad: bool, floating: bool
) -> dict[str, Column]:
    out = {}
    for p in periods:
        earlier = frame.once(F.lag(col, p).over(frame.order))
        current = frame.filled(name) if pad else col
        base = frame.once(F.lag(current, p).over(frame.order)) if pad else earlier
        out[f"{name}_diff_{p}"] = known(col - earlier) if floating else col - earlier
        out[f"{name}_pct_change_{p}"] = divide(current, base) - 1
    return out


def rolling_features(
    df: DataFrame,
    columns: list[str],
    windows: Sequence[int],
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    min_periods: int | None = 1,
    layout: Layout = Layout(),
) -> DataFrame:
    """Rolling mean, sample standard deviation, minimum and maximum over trailing ROWS windows."""
    columns = present(df, columns)

    def build(frame: Frame) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for c in columns:
            out |= rolling_columns(frame, c, value(df, c), windows, min_periods)
        return out

    return over_rows(
        df, build, order_by=order_by, partition_by=partition_by, lookback=max(windows, default=1) - 1, layout=layout
    )


def lag_features(
    df: DataFrame,
    columns: list[str],
    lags: Sequence[int],
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    layout: Layout = Layout(),
) -> DataFrame:
    """Values ``n`` rows earlier; a negative ``n`` looks ahead."""
    columns = present(df, columns)

    def build(frame: Frame) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for c in columns:
            out |= lag_columns(frame, c, value(df, c), lags)
        return out

    return over_rows(
        df,
        build,
        order_by=order_by,
        partition_by=partition_by,
        lookback=max([0, *lags]),
        lookahead=max([0, *[-n for n in lags]]),
        layout=layout,
    )


def difference_features(
    df: DataFrame,
    columns: list[str],
    periods: Sequence[int] = (1,),
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    fill: str = "pad",
    layout: Layout = Layout(),
) -> DataFrame:
    """Difference and relative change against the value ``p`` rows earlier.

    With ``fill="pad"`` the relative change carries the last known value over gaps first; ``"none"`` does not.
    """
    if fill not in ("pad", "none"):
        raise ValueError(f"unknown fill: {fill!r}")
    columns = present(df, columns)
    pad = fill == "pad"

    def build(frame: Frame) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for c in columns:
            out |= difference_columns(frame, c, value(df, c), periods, pad, is_floating(df, c))
        return out

    return over_rows(
        df,
        build,
        order_by=order_by,
        partition_by=partition_by,
        lookback=max(periods, default=0),
        fill={c: value(df, c) for c in columns} if pad else None,
        layout=layout,
    )


def engineer_features(
    df: DataFrame,
    config: dict,
    value_cols: list[str] | None = None,
    *,
    order_by: Sequence[str] = ("date",),
    partition_by: Sequence[str] = (),
    fill: str = "pad",
    layout: Layout = Layout(),
) -> DataFrame:
    """All configured features in one ordered pass: calendar, rolling, lags, and differences of period 1."""
    settings = config.get("features") or {}
    windows = settings.get("rolling_windows") or []
    lags = settings.get("lag_features") or []
    columns = metric_columns(df) if value_cols is None else present(df, value_cols)
    pad = fill == "pad"

    typed = parse_date(df)
    if settings.get("seasonal_features", False) and "date" in df.columns:
        typed = seasonal_features(typed)

    def build(frame: Frame) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for c in columns:
            out |= rolling_columns(frame, c, value(df, c), windows)
        for c in columns:
            out |= lag_columns(frame, c, value(df, c), lags)
        for c in columns:
            out |= difference_columns(frame, c, value(df, c), [1], pad, is_floating(df, c))
        return out

    return over_rows(
        typed,
        build,
        order_by=order_by,
        partition_by=partition_by,
        lookback=max([w - 1 for w in windows] + list(lags) + [1]),
        lookahead=max([0, *[-n for n in lags]]),
        fill={c: value(df, c) for c in columns} if pad else None,
        layout=layout,
    )
