"""Data-quality checks.

``quality_table`` computes every scalar check of a table in one aggregate pass and returns them as long rows
``(dataset_id, check, column, metric, bound, value, passed)``. The single checks below it return the same facts
in their own shape.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.calendar import parse_date
from tidewatch.functions.columns import numeric_columns
from tidewatch.functions.missing import quoted, text_literal, value, value_sql
from tidewatch.operators.quantiles import EXACT_ROWS, exact_quantiles

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("bound", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("passed", T.BooleanType()),
    ]
)

# Column-name patterns with built-in bounds.
NON_NEGATIVE_FRAGMENTS = ("admission", "beds_used", "icu_beds")
PERCENT_SUFFIX = "_rate"
FRACTION_FRAGMENT = "occupancy"
FRACTION_MAX = 1.5
DEFAULT_MISSING_THRESHOLD = 0.3
DEFAULT_GROUP_COLUMNS = ("region", "hospital_id")


class QualityError(Exception):
    """A check that fails the whole dataset."""


@dataclass(frozen=True)
class Bound:
    column: str
    low: float | None = None
    high: float | None = None
    # A bound that only holds while the column stays at or below this maximum (fractions against percentages).
    if_max_at_most: float | None = None


def _absent_text(columns: Sequence[str]) -> str:
    return f"required columns are absent: {', '.join(columns)}"


def _sparse_text(columns: Sequence[str]) -> str:
    return f"too many missing values in: {', '.join(columns)}"


def required_columns(df: DataFrame, required: Sequence[str]) -> dict:
    """Present and missing required columns; raises when one is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityError(_absent_text(missing))
    return {
        "required_columns": list(required),
        "present_columns": list(required),
        "missing_columns": [],
        "passed": True,
    }


def _missing(df: DataFrame, name: str) -> Column:
    return value(df, name).isNull()


def _need_date(df: DataFrame, date_col: str) -> None:
    if date_col not in df.columns:
        raise QualityError(f"the table has no date column {date_col!r}")


def groups_with_missing_dates(df: DataFrame, date_col: str, group_cols: Sequence[str]) -> DataFrame:
    """Groups that hold an undated row, with the number of such rows; rows without a full group key are ignored.

    Sorted dates can only fail to ascend where a date is missing, so the undated rows are all that has to be read.
    """
    _need_date(df, date_col)
    undated = parse_date(df, date_col).where(F.col(date_col).isNull())
    return undated.dropna(subset=list(group_cols)).groupBy(*group_cols).agg(F.count("*").alias("missing_dates"))


def date_monotonic(df: DataFrame, date_col: str = "date", group_cols: Sequence[str] | None = None) -> dict:
    """Whether the dates ascend once sorted, over the table or inside every group."""
    _need_date(df, date_col)
    if group_cols:
        groups = groups_with_missing_dates(df, date_col, group_cols)
        passed = groups.isEmpty()
        return {
            "date_column": date_col,
            "group_columns": list(group_cols),
            "non_monotonic_groups": groups,
            "passed": passed,
        }
    passed = parse_date(df, date_col).where(F.col(date_col).isNull()).isEmpty()
    return {"date_column": date_col, "is_monotonic": passed, "passed": passed}


def missing_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing values per column, as (column, ratio)."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.avg(_missing(df, c).cast("int")).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "ratio")


def missingness(df: DataFrame, threshold: float = DEFAULT_MISSING_THRESHOLD, fail_on_threshold: bool = False) -> dict:
    """Missing ratio by column name; optionally raises for columns above the threshold."""
    row = df.agg(*[F.avg(_missing(df, c).cast("int")).alias(c) for c in df.columns]).first()
    ratios = row.asDict()
    over = [c for c, ratio in ratios.items() if ratio is not None and ratio > threshold]
    if fail_on_threshold and over:
        raise QualityError(_sparse_text(over))
    return ratios


def configured_bounds(df: DataFrame, config: dict | None) -> list[Bound]:
    """Bounds from ``{column: {"min": .., "max": ..}}``; columns that do not exist are skipped."""
    return [Bound(c, b.get("min"), b.get("max")) for c, b in (config or {}).items() if c in df.columns]


def discovered_bounds(df: DataFrame, config: dict | None = None) -> list[Bound]:
    """Bounds implied by the names of numeric columns; configured columns keep their own."""
    found = []
    for c in numeric_columns(df):
        name = c.lower()
        if c in (config or {}):
            continue
        if any(part in name for part in NON_NEGATIVE_FRAGMENTS):
            found.append(Bound(c, low=0))
        elif name.endswith(PERCENT_SUFFIX):
            found.append(Bound(c, low=0, high=100))
        elif FRACTION_FRAGMENT in name:
            found.append(Bound(c, low=0, high=1, if_max_at_most=FRACTION_MAX))
    return found


def numeric_bounds(df: DataFrame, bounds: Sequence[Bound]) -> DataFrame:
    """Violated bounds as (column, type, bound, count, percentage of all rows)."""
    rows = [
        f"named_struct('column', {text_literal(b.column)}, 'type', '{kind}', 'bound', double({limit!r}),"
        f" 'count', {count}, 'percentage', {_percentage(count)}, 'applies', {_applies(df, b)})"
        for b in bounds
        for kind, limit, count in _violations(df, b)
    ]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column string, type string, bound double, count bigint, percentage double"
        )
    return _inline(df, rows).where("applies AND count > 0").drop("applies")


def _inline(df: DataFrame, rows: list[str]) -> DataFrame:
    """Aggregate structs, given as SQL text, turned into rows."""
    return df.agg(F.expr(f"array({', '.join(rows)})").alias("rows")).select(F.inline("rows"))


def _violations(df: DataFrame, bound: Bound) -> list[tuple[str, float, str]]:
    """(type, bound, SQL count of violations) for each given side."""
    x = value_sql(df, bound.column)
    sides = (("below_minimum", bound.low, "<"), ("above_maximum", bound.high, ">"))
    return [(kind, float(b), f"count_if({x} {sign} double({float(b)!r}))") for kind, b, sign in sides if b is not None]


def _percentage(count: str) -> str:
    return f"try_divide({count}, count(*)) * 100"


def _applies(df: DataFrame, bound: Bound) -> str:
    if bound.if_max_at_most is None:
        return "true"
    return f"coalesce(max({value_sql(df, bound.column)}) <= double({bound.if_max_at_most!r}), false)"


def date_extent(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last date, as one row."""
    return parse_date(df, date_col).agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def covers_date_range(df: DataFrame, date_col: str, start: str, end: str) -> bool:
    return parse_date(df, date_col).agg(F.expr(_covers(date_col, start, end))).first()[0]


def _covers(date_col: str, start: str, end: str) -> str:
    date = quoted(date_col)
    first, last = (f"CAST({text_literal(str(t))} AS TIMESTAMP_NTZ)" for t in (start, end))
    return f"coalesce(min({date}) <= {first} AND max({date}) >= {last}, false)"


def check_seasonality(df: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Variation of the monthly means, and the peak and trough months (the earlier month on ties), as one row."""
    typed = parse_date(df, date_col).where(F.col(date_col).isNotNull())
    monthly = typed.groupBy(F.month(date_col).alias("month")).agg(F.avg(value(df, value_col)).alias("v"))
    # A month without any value has no mean and can be neither peak nor trough.
    known = monthly.where(F.col("v").isNotNull())
    return known.agg(
        F.try_divide(F.stddev_samp("v"), F.avg("v")).alias("coefficient_of_variation"),
        F.min_by("month", F.struct(-F.col("v"), "month")).alias("peak_month"),
        F.min_by("month", F.struct("v", "month")).alias("trough_month"),
        F.max("v").alias("peak_value"),
        F.min("v").alias("trough_value"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, column count and column names, as one row."""
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
    )


def summary_stats(df: DataFrame, columns: list[str] | None = None, *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], exact_rows=exact_rows)
    rows = []
    for c in columns:
        x = value(df, c)
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ("q25", "q50", "q75"))],
                F.max(x).cast("double").alias("max"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def date_summary(df: DataFrame, date_col: str = "date", *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Count, minimum, mean, quartiles and maximum of a date column, as timestamps in one row."""
    typed = parse_date(df, date_col)
    micros = typed.select(_micros(F.col(date_col)).alias("t"))
    q25, q50, q75 = exact_quantiles(micros, ["t"], [0.25, 0.5, 0.75], exact_rows=exact_rows)["t"]

    def moment(c: Column) -> Column:
        return F.timestamp_micros(F.round(c).cast("long")).cast("timestamp_ntz")

    return micros.agg(
        F.count("t").alias("count"),
        moment(F.min("t")).alias("min"),
        moment(F.avg("t")).alias("mean"),
        *[moment(F.lit(q).cast("double")).alias(n) for q, n in ((q25, "q25"), (q50, "q50"), (q75, "q75"))],
        moment(F.max("t")).alias("max"),
    )


def _micros(date: Column) -> Column:
    return F.unix_micros(date.cast("timestamp"))


def missing_threshold(config: dict) -> float:
    qc, processing = config.get("qc") or {}, config.get("processing") or {}
    return qc.get("missing_threshold", processing.get("missing_threshold", DEFAULT_MISSING_THRESHOLD))


def quality_table(df: DataFrame, dataset_id: str, config: dict) -> DataFrame:
    """Every scalar check of one table as long rows, from a single aggregate over a single scan."""
    qc = config.get("qc") or {}
    date_col = qc.get("date_column", "date")
    dated = date_col in df.columns
    typed = parse_date(df, date_col) if dated else df
    rows: list[str] = []

    def add(check, column, metric, bound, measured, passed="NULL", applies="true"):
        limit = "NULL" if bound is None else repr(float(bound))
        rows.append(
            f"named_struct('dataset_id', {text_literal(dataset_id)}, 'check', '{check}',"
            f" 'column', {text_literal(column)}, 'metric', '{metric}', 'bound', double({limit}),"
            f" 'value', double({measured}), 'passed', boolean({passed}), 'applies', {applies})"
        )

    add("profile", None, "row_count", None, "count(*)")
    add("profile", None, "column_count", None, len(df.columns))
    for c in qc.get("required_columns", ["date"]):
        here = c in df.columns
        add("required_columns", c, "present", None, int(here), str(here))
    if dated:
        keyed = "".join(f" AND {value_sql(df, c)} IS NOT NULL" for c in group_columns(df, qc))
        undated = f"count_if({quoted(date_col)} IS NULL{keyed})"
        add("date_monotonic", date_col, "missing_dates", None, undated, f"{undated} = 0")
    threshold = missing_threshold(config)
    for c in df.columns:
        ratio = f"avg(int({value_sql(df, c)} IS NULL))"
        add("missingness", c, "ratio", threshold, ratio, f"coalesce({ratio} <= double({threshold!r}), true)")
    given = qc.get("numeric_bounds")
    for b in configured_bounds(df, given) + discovered_bounds(df, given):
        for kind, limit, count in _violations(df, b):
            add("numeric_bounds", b.column, kind, limit, count, f"{count} = 0", _applies(df, b))
            add("numeric_bounds", b.column, f"{kind}_pct", limit, _percentage(count), f"{count} = 0", _applies(df, b))
    if "date_range" in config and dated:
        covered = _covers(date_col, config["date_range"]["start"], config["date_range"]["end"])
        add("date_range", date_col, "covered", None, f"int({covered})", covered)
    return _inline(typed, rows).where("applies").drop("applies")


def group_columns(df: DataFrame, qc: dict) -> list[str]:
    """The configured grouping columns that the table has."""
    return [c for c in qc.get("date_monotonic_group_by", DEFAULT_GROUP_COLUMNS) if c in df.columns]


def failure_text(rows: Sequence[Row], fail_on_missing: bool) -> str | None:
    """Why a dataset fails: absent required columns always, missing values only on request; nothing else does."""
    absent = [r["column"] for r in rows if r["check"] == "required_columns" and not r["passed"]]
    if absent:
        return _absent_text(absent)
    over = [r["column"] for r in rows if r["check"] == "missingness" and not r["passed"]]
    if fail_on_missing and over:
        return _sparse_text(over)
    return None
