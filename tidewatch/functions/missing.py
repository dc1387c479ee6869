"""Missing values.

NULL is the only missing marker inside the library. Spark lets a NaN poison ``avg``, ``stddev`` and ``max`` and
treats it as larger than every number, so NaN becomes NULL wherever a metric is read.

Conditions over many columns are written as SQL text: one expression instead of a call into the JVM per operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str | None) -> str:
    """A string as SQL text."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FLOATING)


def value_sql(df: DataFrame, name: str) -> str:
    return f"nanvl({quoted(name)}, NULL)" if is_floating(df, name) else quoted(name)


def value(df: DataFrame, name: str) -> Column:
    """Column ``name`` with NaN read as NULL."""
    return F.expr(value_sql(df, name))


def _finite_sql(df: DataFrame, name: str) -> str:
    present = f"{quoted(name)} IS NOT NULL"
    if not is_floating(df, name):
        return present
    return f"{present} AND NOT isnan({quoted(name)}) AND abs({quoted(name)}) != double('infinity')"


def finite_value(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double with NaN and both infinities read as NULL."""
    number = f"CAST({quoted(name)} AS DOUBLE)"
    return F.expr(f"CASE WHEN {_finite_sql(df, name)} THEN {number} END" if is_floating(df, name) else number)


def all_finite(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether every one of the columns holds a number: not NULL, NaN or an infinity."""
    return F.expr(" AND ".join(_finite_sql(df, c) for c in columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """The whole table with NaN replaced by NULL in every floating column."""
    return df.select(*[value(df, c).alias(c) for c in df.columns])


def known(number: Column) -> Column:
    """A computed double with NaN, the result of inf - inf and inf / inf, as NULL."""
    return F.nanvl(number.cast("double"), F.lit(None).cast("double"))


def divide(numerator: Column, denominator: Column) -> Column:
    """Float division that never raises: x/0 is a signed infinity and 0/0 is missing."""
    top = numerator.cast("double")
    inf = F.lit(float("inf"))
    return F.when(denominator == 0, F.when(top > 0, inf).when(top < 0, -inf)).otherwise(
        known(F.try_divide(top, denominator.cast("double")))
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep complete rows only; infinities count as present.

    One condition per column rather than ``dropna``: its single condition over all columns makes the optimizer's
    constraint set double with every renamed column above it.
    """
    names = df.columns if columns is None else columns
    return df.where(" AND ".join(f"{value_sql(df, c)} IS NOT NULL" for c in names)) if names else df


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mean of the finite values of each column, as one aggregate row."""
    row = df.agg(*[F.avg(finite_value(df, c)).alias(c) for c in columns]).first()
    return row.asDict()


def impute(df: DataFrame, fills: dict[str, float | None]) -> DataFrame:
    """Replace missing values by a given per-column constant (usually the training means)."""
    out = {}
    for name, fill in fills.items():
        if fill is not None:
            out[name] = F.coalesce(value(df, name).cast("double"), F.lit(float(fill)))
    return df.withColumns(out) if out else df
