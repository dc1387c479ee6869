"""Inputs shared by several queries, in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.series import region_daily, table



def exact_mean(column: str, places: int = 2) -> str:
    """Mean of numbers of so many places to six digits, halves away from zero, in whole numbers."""
    units, n = f"CAST(sum(CAST({column} AS DECIMAL(20, {places}))) * {10**places} AS HUGEINT)", f"count({column})"
    return f"sign({units}) * ((2 * abs({units}) * {10 ** (6 - places)} + {n}) // (2 * {n})) / 1000000.0"


REGION_DAILY = """region_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, r_name AS region, CAST(count(*) AS BIGINT) AS orders,
         round(sum(o_totalprice), 2) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2)"""

SHIP_DAILY = f"""ship_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag, CAST(count(*) AS BIGINT) AS items,
         round(sum(l_quantity), 2) AS quantity, {exact_mean("l_discount")} AS avg_discount
  FROM lineitem GROUP BY 1, 2)"""

EVENT_HOURLY = f"""event_hourly AS (
  SELECT date_trunc('hour', ts) AS hour, event_type, CAST(count(*) AS BIGINT) AS events,
         round(sum(value), 2) AS value_sum, {exact_mean("value")} AS value_avg
  FROM events GROUP BY 1, 2)"""

GAPPY = """gappy AS (
  SELECT event_id, ts, CASE WHEN event_type <> 'signup' THEN ts END AS date, event_type, user_id,
         CASE WHEN event_type = 'error' THEN NULL WHEN value < 1 THEN 0.0 ELSE value END AS reading
  FROM events)"""

SCORED_EVENTS = """scored AS (
  SELECT event_id, ts, event_type, user_id, value, -value / 100 AS anomaly_score, value > 60 AS is_anomaly
  FROM events)"""

SCORED_DAILY = f"""{REGION_DAILY}, scored AS (
  SELECT *, -round(abs(revenue - avg(revenue) OVER ()) / stddev_samp(revenue) OVER (), 6) AS anomaly_score,
         round(abs(revenue - avg(revenue) OVER ()) / stddev_samp(revenue) OVER (), 6) > 1.5 AS is_anomaly
  FROM region_daily)"""


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a score that falls with the value and a flag on values above 60."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        "event_type",
        "user_id",
        "value",
        (-F.col("value") / 100).alias("anomaly_score"),
        (F.col("value") > 60).alias("is_anomaly"),
    )


def scored_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Region days scored by their distance from the mean revenue, flagged beyond 1.5 standard deviations."""
    daily = region_daily(spark, folder)
    stats = daily.agg(F.avg("revenue").alias("m"), F.stddev_samp("revenue").alias("s")).first()
    distance = F.round(F.abs(F.col("revenue") - F.lit(stats["m"])) / F.lit(stats["s"]), 6)
    return daily.withColumns({"anomaly_score": -distance, "is_anomaly": distance > 1.5})


def rounded(df: DataFrame, places: int = 6, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column except ``keep``."""
    return df.select(
        *[
            F.round(f"`{f.name}`", places).alias(f.name)
            if f.dataType.typeName() == "double" and f.name not in keep
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
