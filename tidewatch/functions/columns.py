"""Discovery of columns from the schema; nothing here starts a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names and name fragments that decide which columns are metrics, features and report values.
DIMENSIONS = ("date", "region", "hospital_id")
CALENDAR_PARTS = ("year", "month", "day", "quarter", "week_of_year", "day_of_week", "day_of_year")
NOTEBOOK_EXCLUDED = ("date", "region", "hospital_id", "year", "month", "day")
NON_METRIC_FRAGMENTS = ("id", "year", "month", "day", "week", "quarter")
OUTLIER_SUFFIX = "_outlier"


def snake_case_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn blanks and dashes into underscores."""
    names = [c.lower().translate(str.maketrans(" -", "__")) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return df.toDF(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def metric_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose name holds none of the id/calendar fragments (a plain substring test)."""
    return [c for c in numeric_columns(df) if not any(part in c.lower() for part in NON_METRIC_FRAGMENTS)]


def feature_columns(df: DataFrame, excluded: tuple[str, ...] = DIMENSIONS + CALENDAR_PARTS) -> list[str]:
    """Columns of the model matrix, in table order: no dimensions, raw calendar parts or outlier flags."""
    return [c for c in df.columns if c not in excluded and not c.endswith(OUTLIER_SUFFIX)]


def report_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in DIMENSIONS]


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The requested columns that exist; absent ones are skipped."""
    return [c for c in columns if c in df.columns]


def widest_table(tables: dict[str, DataFrame]) -> str:
    """Id of the table with most columns; the first one wins a tie."""
    if not tables:
        raise ValueError("no tables given")
    return max(tables, key=lambda name: len(tables[name].columns))
