"""Top-k reports. ``k`` is the size of the report, so only k rows per task travel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.missing import value


def _severity(df: DataFrame, score_col: str, ascending: bool) -> Column:
    score = value(df, score_col)
    return score.asc_nulls_last() if ascending else score.desc_nulls_last()


def top_anomalies(
    df: DataFrame, score_col: str, k: int = 20, ascending: bool = True, *, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The k lowest (or highest) scores in order; missing scores come last and ``tiebreak`` settles equal ones."""
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in tiebreak]
    return df.orderBy(_severity(df, score_col, ascending), *ties).limit(k)


def top_flagged(
    df: DataFrame,
    score_col: str,
    columns: list[str],
    k: int = 10,
    *,
    flag_col: str = "is_anomaly",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The k most severe rows among the flagged ones, reduced to the given columns."""
    return top_anomalies(df.where(F.col(flag_col)), score_col, k, tiebreak=tiebreak).select(*columns)


def top_per_series(
    df: DataFrame,
    score_col: str,
    k: int,
    *,
    partition_by: Sequence[str],
    ascending: bool = True,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The k most severe rows of every series with their rank; each task keeps k rows per series before the shuffle."""
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in tiebreak]
    severity = Window.partitionBy(*partition_by).orderBy(_severity(df, score_col, ascending), *ties)
    return df.withColumn("rank", F.row_number().over(severity)).where(F.col("rank") <= k)
