"""Combining several daily tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import numeric_columns
from tidewatch.functions.missing import value


def fuse_tables(tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key found in any table, with the mean of every table's numeric metrics, prefixed by the table id.

    The same result as a full outer join of the tables reduced to unique keys, but stacked and aggregated instead: one
    shuffle of partial means for any number of tables, and a key with very many rows is combined before it travels.
    Rows with a missing key are dropped. A decimal metric is averaged as a decimal, so its mean does not depend on the
    order of its terms, and comes back as a double like all others.
    """
    sides, metrics = [], []
    for name, df in tables.items():
        own = [c for c in numeric_columns(df) if c not in keys]
        sides.append(df.dropna(subset=list(keys)).select(*keys, *[value(df, c).alias(f"{name}_{c}") for c in own]))
        metrics += [f"{name}_{c}" for c in own]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    return stacked.groupBy(*keys).agg(*[F.avg(f"`{m}`").cast("double").alias(m) for m in metrics])
