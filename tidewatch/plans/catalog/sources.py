"""Sources, sinks, normalisation, and the derived series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.columns import widest_table
from tidewatch.operators.fusion import fuse_tables
from tidewatch.operators.ordered import ROW, index_rows
from tidewatch.plans.catalog.shared import EVENT_HOURLY, REGION_DAILY, SHIP_DAILY, exact_mean, rounded
from tidewatch.sources.ingest import ingest_tables
from tidewatch.sources.series import event_hourly, region_daily, ship_daily, table
from tidewatch.sources.staging import staging_path
from tidewatch.sources.tables import load_csv, load_ingested, load_parquet, processed_path, save_csv, save_parquet

_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
)


def _normalised(spark, folder):
    """Orders under untidy names and with the date as text, ingested; the processed copy is returned."""
    untidy = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_orderstatus").alias("Order-Status"),
        F.col("o_totalprice").alias("Total Price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    root = staging_path(spark, "ingest")
    ingest_tables(spark, {"orders": untidy}, root)
    return load_parquet(spark, processed_path(root, "local", "orders"))


def _raw_copies(spark, folder):
    """Two tables ingested from their paths and loaded back by id."""
    root = staging_path(spark, "ingest")
    ingest_tables(spark, {n: f"{folder}/{n}.parquet" for n in ("customer", "supplier")}, root)
    tables = load_ingested(spark, ["customer", "supplier"], root, "local")

    def parties(name, key, balance):
        return tables[name].select(
            F.lit(name).alias("party"), F.col(key).alias("party_key"), F.col(balance).alias("balance")
        )

    customers = parties("customer", "c_custkey", "c_acctbal")
    return customers.unionByName(parties("supplier", "s_suppkey", "s_acctbal"))


def _csv_copy(spark, folder):
    customer = table(spark, folder, "customer")
    path = save_csv(customer, staging_path(spark, "csv"))
    return load_csv(spark, path, schema=customer.schema)


def _parquet_copy(spark, folder):
    path = save_parquet(table(spark, folder, "lineitem"), staging_path(spark, "lineitem"), partition_by=["l_returnflag"])
    return load_parquet(spark, path)


def _widest(spark, folder):
    tables = {n: table(spark, folder, n) for n in _NAMES.split()}
    name = widest_table(tables)
    return tables[name].agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_id"), F.lit(len(tables[name].columns)).alias("column_count"), "row_count"
    )


def _exact(df, **places):
    """Columns as decimals: means of doubles depend on the order of their terms."""
    return df.withColumns({c: F.col(c).cast(f"decimal(20,{n})") for c, n in places.items()})


def _fused(spark, folder):
    return rounded(
        fuse_tables(
            {
                "sales": _exact(region_daily(spark, folder), revenue=2),
                "shipping": _exact(ship_daily(spark, folder), quantity=2, avg_discount=6),
                "web": _exact(event_hourly(spark, folder), value_sum=2, value_avg=6).withColumn("date", F.to_date("hour")),
            },
            ["date"],
        )
    )


def _row_order(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return index_rows(events, ["ts", "event_id"], ["event_type"]).select("event_id", F.col(ROW).alias("position"))


def _clipped(spark, folder):
    """Floor at zero, clip to a percentage, and a ratio that tolerates an empty denominator."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.greatest(F.lit(0.0), F.col("l_quantity") - 20).cast("bigint").alias("floored"),
        F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.round(F.col("l_extendedprice") / 500 - 20, 6))).alias("clipped"),
        F.round(F.try_divide(F.col("l_discount"), F.col("l_tax")) * 100, 6).alias("ratio"),
    )


QUERIES = {
    "series_region_daily": region_daily,
    "series_ship_daily": lambda s, d: rounded(ship_daily(s, d)),
    "series_event_hourly": lambda s, d: rounded(event_hourly(s, d)),
    "normalised_columns": _normalised,
    "ingested_raw": _raw_copies,
    "csv_roundtrip": _csv_copy,
    "parquet_roundtrip": _parquet_copy,
    "widest_table": _widest,
    "fused_daily": _fused,
    "row_order": _row_order,
    "clip_and_ratio": _clipped,
}

SQL = {
    "series_region_daily": f"WITH {REGION_DAILY} SELECT * FROM region_daily",
    "series_ship_daily": f"""
        WITH {SHIP_DAILY}
        SELECT date, l_returnflag, items, round(quantity, 6) AS quantity, round(avg_discount, 6) AS avg_discount
        FROM ship_daily""",
    "series_event_hourly": f"""
        WITH {EVENT_HOURLY}
        SELECT hour, event_type, events, round(value_sum, 6) AS value_sum, round(value_avg, 6) AS value_avg
        FROM event_hourly""",
    "normalised_columns": """
        SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS total_price,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date
        FROM orders""",
    "ingested_raw": """
        SELECT 'customer' AS party, c_custkey AS party_key, c_acctbal AS balance FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
    "csv_roundtrip": "SELECT * FROM customer",
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "widest_table": "SELECT 'lineitem' AS table_id, 11 AS column_count, count(*) AS row_count FROM lineitem",
    "fused_daily": f"""
        WITH {REGION_DAILY}, {SHIP_DAILY}, {EVENT_HOURLY},
        a AS (SELECT date, avg(orders) AS sales_orders, {exact_mean("revenue")} AS sales_revenue
              FROM region_daily GROUP BY date),
        b AS (SELECT date, avg(items) AS shipping_items, {exact_mean("quantity")} AS shipping_quantity,
                     {exact_mean("avg_discount", 6)} AS shipping_avg_discount FROM ship_daily GROUP BY date),
        c AS (SELECT CAST(hour AS DATE) AS date, avg(events) AS web_events, {exact_mean("value_sum")} AS web_value_sum,
                     {exact_mean("value_avg", 6)} AS web_value_avg FROM event_hourly GROUP BY 1)
        SELECT date, round(sales_orders, 6) AS sales_orders, round(sales_revenue, 6) AS sales_revenue,
               round(shipping_items, 6) AS shipping_items, round(shipping_quantity, 6) AS shipping_quantity,
               round(shipping_avg_discount, 6) AS shipping_avg_discount, round(web_events, 6) AS web_events,
               round(web_value_sum, 6) AS web_value_sum, round(web_value_avg, 6) AS web_value_avg
        FROM a FULL JOIN b USING (date) FULL JOIN c USING (date)""",
    "row_order": """
        SELECT event_id, row_number() OVER (ORDER BY event_type, ts, event_id) - 1 AS position FROM events""",
    "clip_and_ratio": """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(greatest(0.0, l_quantity - 20)) AS BIGINT) AS floored,
               least(100.0, greatest(0.0, round(l_extendedprice / 500 - 20, 6))) AS clipped,
               round(CASE WHEN l_tax <> 0 THEN l_discount / l_tax END * 100, 6) AS ratio
        FROM lineitem""",
}
