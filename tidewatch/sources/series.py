"""Daily and hourly series drawn from the order, shipment and event tables.

Amounts are kept to the cent, and their means to six digits, so that neither depends on the order of its terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mean_of_cents(column: str) -> Column:
    """The mean of an amount in cents, exact to six digits."""
    return F.avg(F.col(column).cast("decimal(18,2)")).cast("double")


def region_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and revenue by day and region of the customer; unique by (date, region)."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.to_date("o_orderdate").alias("date"), F.col("r_name").alias("region"))
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )


def ship_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Shipped items, quantity and mean discount by day and return flag; unique by (date, l_returnflag)."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"), "l_returnflag")
        .agg(
            F.count("*").alias("items"),
            F.round(F.sum("l_quantity"), 2).alias("quantity"),
            mean_of_cents("l_discount").alias("avg_discount"),
        )
    )


def event_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Events and values by hour and event type; unique by (hour, event_type)."""
    return (
        table(spark, folder, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type")
        .agg(
            F.count("*").alias("events"),
            F.round(F.sum("value"), 2).alias("value_sum"),
            mean_of_cents("value").alias("value_avg"),
        )
    )


def gappy_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a series with gaps: errors carry no reading, readings below 1 count as 0, signups are undated."""
    reading = F.when(F.col("event_type") == "error", None).when(F.col("value") < 1, 0.0).otherwise(F.col("value"))
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("date"),
        "event_type",
        "user_id",
        reading.alias("reading"),
    )
