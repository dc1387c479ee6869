"""Seeded daily series with a yearly cycle and planted anomalies, for demonstrations and tests."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import value_at_rank


@dataclass(frozen=True)
class Shape:
    base: float
    amplitude: float
    noise: float
    bump_mean: float
    bump_std: float


# The three kinds of series, recognised by a fragment of the dataset id.
SHAPES = {
    "admissions": Shape(50, 20, 5, 30, 10),
    "occupancy": Shape(75, 10, 3, 15, 5),
    "icu": Shape(15, 5, 2, 10, 3),
}
REGIONS = ("Ontario", "Quebec", "BC", "Alberta")
SITES = 20
START, DAYS, SEED = "2019-01-01", 1826, 42
ANOMALY_SHARE = 0.05
ICU_BEDS = 25


def synthetic_series(
    spark: SparkSession, dataset_id: str, *, days: int = DAYS, start: str = START, seed: int = SEED, truth: bool = False
) -> DataFrame:
    """One row per day: date, region, hospital_id and the metrics of the kind named in ``dataset_id``.

    ``int(days * 5 %)`` days get a bump; ``truth=True`` adds the flag ``planted``.
    """
    kind = next((k for k in SHAPES if k in dataset_id), None)
    days_df = spark.range(days).withColumnRenamed("id", "day")
    base = days_df.select(
        "day",
        F.date_add(F.lit(start).cast("date"), F.col("day").cast("int")).cast("timestamp_ntz").alias("date"),
        _choice([F.lit(r) for r in REGIONS], seed + 1).alias("region"),
        F.format_string("H%03d", 1 + F.floor(_uniform(seed + 2) * SITES).cast("int")).alias("hospital_id"),
    )
    if kind is None:
        return base.drop("day")
    shape = SHAPES[kind]
    wave = shape.base + shape.amplitude * F.sin(F.lit(2 * math.pi) * F.col("day") / F.lit(365.0))
    bump = F.when(F.col("planted"), shape.bump_mean + shape.bump_std * _normal(seed + 4)).otherwise(0.0)
    noisy = _plant(base, days, seed).withColumn("x", wave + shape.noise * _normal(seed + 3) + bump)
    out = noisy.withColumns(_metrics(kind, F.col("x"))).drop("day", "x")
    return out if truth else out.drop("planted")


def _metrics(kind: str, x: Column) -> dict[str, Column]:
    floored = F.greatest(F.lit(0.0), x).cast("bigint")
    if kind == "admissions":
        return {"admissions": floored}
    if kind == "occupancy":
        return {"occupancy_rate": _clip(x)}
    total = F.lit(ICU_BEDS).cast("bigint")
    return {
        "icu_beds_used": floored,
        "icu_beds_total": total,
        "icu_utilization_rate": _clip(F.try_divide(floored, total) * 100),
    }


def _clip(x: Column) -> Column:
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), x))


def _uniform(seed: int) -> Column:
    """A number in [0, 1) from the day, the same on any cluster."""
    return F.shiftrightunsigned(F.xxhash64(F.col("day"), F.lit(seed)), 11) / F.lit(float(1 << 53))


def _normal(seed: int) -> Column:
    """A standard normal number from the day (Box and Muller)."""
    length = F.sqrt(-2 * F.log1p(-_uniform(seed)))
    return length * F.cos(2 * math.pi * _uniform(seed + 1_000_003))


def _choice(options: list[Column], seed: int) -> Column:
    return F.get(F.array(*options), F.floor(_uniform(seed) * len(options)).cast("int"))


def _plant(base: DataFrame, days: int, seed: int) -> DataFrame:
    """Flag exactly ``int(days * share)`` days: those with the smallest hash."""
    wanted = int(days * ANOMALY_SHARE)
    # 53 bits, so that the hash is exact as a double.
    draw = F.shiftrightunsigned(F.xxhash64(F.col("day"), F.lit(seed)), 11)
    hashed = base.sparkSession.range(days).select(F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11).alias("h"))
    limit = value_at_rank(hashed, "h", wanted - 1) if wanted else None
    return base.withColumn("planted", F.lit(False) if limit is None else draw <= F.lit(int(limit)))
