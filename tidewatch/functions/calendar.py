"""Calendar parts, cyclical encodings and date typing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Type a date column; unreadable text raises (ANSI cast). Tables without the column pass through."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if column not in df.columns or isinstance(df.schema[column].dataType, dated):
        return df
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def calendar_parts(date: Column) -> dict[str, Column]:
    """Integer parts; Monday is day 0 of the week and weeks follow ISO 8601."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.weekday(date),
        "day_of_year": F.dayofyear(date),
        "quarter": F.quarter(date),
        "week_of_year": F.weekofyear(date),
    }


def cyclical_parts(date: Column) -> dict[str, Column]:
    """Month and weekday as points on the unit circle, so December is next to January."""

    def angle(part: Column, period: int) -> Column:
        return part * F.lit(2 * math.pi) / F.lit(float(period))

    month, weekday = angle(F.month(date), 12), angle(F.weekday(date), 7)
    return {
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
        "dow_sin": F.sin(weekday),
        "dow_cos": F.cos(weekday),
    }


def seasonal_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add the seven calendar parts and four cyclical encodings."""
    typed = parse_date(df, date_col)
    date = F.col(date_col)
    return typed.withColumns({**calendar_parts(date), **cyclical_parts(date)})
