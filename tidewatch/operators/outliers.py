"""Outlier flags by z-score or interquartile range."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import OUTLIER_SUFFIX, numeric_columns, present
from tidewatch.functions.missing import value
from tidewatch.operators.quantiles import EXACT_ROWS, exact_quantiles


def detect_outliers(
    df: DataFrame,
    columns: list[str],
    method: str = "zscore",
    threshold: float = 3.0,
    *,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Append one ``{column}_outlier`` flag per present column; a missing value is never an outlier."""
    columns = present(df, columns)
    if method == "zscore":
        flags = _zscore_flags(df, columns, threshold)
    elif method == "iqr":
        flags = _iqr_flags(df, columns, threshold, exact_rows)
    else:
        raise ValueError(f"unknown outlier method: {method!r}")
    return df.withColumns({f"{c}{OUTLIER_SUFFIX}": F.coalesce(flag, F.lit(False)) for c, flag in flags.items()})


def _zscore_flags(df, columns, threshold):
    if not columns:
        return {}
    stats = df.agg(
        *[F.avg(value(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(value(df, c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    flags = {}
    for i, c in enumerate(columns):
        mean, std = stats[f"m{i}"], stats[f"s{i}"]
        # An infinity in the column leaves no finite mean or deviation, and then nothing to compare with.
        known = mean is not None and std and math.isfinite(mean) and math.isfinite(std)
        flags[c] = F.abs((value(df, c) - F.lit(mean)) / F.lit(std)) > threshold if known else F.lit(False)
    return flags


def _iqr_flags(df, columns, threshold, exact_rows):
    quartiles = exact_quantiles(df, columns, [0.25, 0.75], exact_rows=exact_rows)
    flags = {}
    for c in columns:
        q1, q3 = quartiles[c]
        if q1 is None:
            flags[c] = F.lit(False)
            continue
        reach = threshold * (q3 - q1)
        fences = (value(df, c) < F.lit(q1 - reach), value(df, c) > F.lit(q3 + reach))
        # Spark holds NaN for the largest number; a fence between infinities is none.
        low, high = (F.lit(False) if math.isnan(at) else f for at, f in zip((q1 - reach, q3 + reach), fences))
        flags[c] = low | high
    return flags


def outlier_summary(df: DataFrame, threshold: float = 3.0, columns: list[str] | None = None) -> DataFrame:
    """Number of z-score outliers per numeric column, as (column, outliers)."""
    columns = numeric_columns(df) if columns is None else present(df, columns)
    flagged = detect_outliers(df, columns, "zscore", threshold)
    counts = flagged.agg(*[F.count_if(F.col(f"`{c}{OUTLIER_SUFFIX}`")).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "outliers")
