"""Rolling, lag and difference features on a stream, series by series.

Series that are said to be short (``DAILY``) keep their last rows in Spark's state store (see ``keyed``). For others each
micro-batch is joined by the last rows of its series and goes through the batch operator, so a busy series is spread in
blocks here too. What the next batch has to see is then written as a small table: per series, as many rows as the widest
feature reaches back plus one older row that carries the last known values for the relative change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.calendar import parse_date, seasonal_features
from tidewatch.functions.columns import present
from tidewatch.functions.missing import value
from tidewatch.operators.features import engineer_features
from tidewatch.operators.ordered import Layout, over_rows
from tidewatch.streaming.keyed import with_keyed_features


def feature_stream(
    stream: DataFrame,
    config: dict,
    value_cols: list[str],
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str],
    target: str,
    checkpoint: str,
    available_now: bool = False,
    layout: Layout = Layout(),
) -> StreamingQuery:
    """Write the features of every arriving row; ``features_of`` and ``late_of`` read what was written.

    Rows that do not come after the newest processed row of their series can no longer change its features; they are
    kept aside without features. With short series the file sink commits each batch with its state. Otherwise each batch
    replaces its own folders and reads the state of the batch before it, so repeating a batch after a failure changes
    nothing.
    """
    settings = config.get("features") or {}
    windows, lags = settings.get("rolling_windows") or [], settings.get("lag_features") or []
    if not partition_by:
        raise ValueError("a feature stream needs the columns that name a series")
    if any(n < 0 for n in lags):
        raise ValueError("a stream cannot look ahead")
    reach = max([w - 1 for w in windows] + list(lags) + [1])
    keys, order, columns = list(partition_by), list(order_by), present(stream, value_cols)
    ordering = {"order_by": order, "partition_by": keys, "layout": layout}
    if not layout.in_blocks:
        none = stream.sparkSession.createDataFrame([], stream.schema)
        like = engineer_features(none, config, columns, **ordering)
        ready = parse_date(stream)
        if settings.get("seasonal_features", False) and "date" in stream.columns:
            ready = seasonal_features(ready)
        rows = with_keyed_features(ready, like, windows, lags, columns, order, keys)
        sink = rows.writeStream.format("parquet").option("path", f"{target}/rows").partitionBy("__late")
        sink = sink.option("checkpointLocation", checkpoint)
        return (sink.trigger(availableNow=True) if available_now else sink).start()

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        known = _read_state(spark, target, batch_id, batch)
        newest = known.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__newest"))
        placed = batch.join(newest, keys, "left")
        late = F.coalesce(F.struct(*order) <= F.col("__newest"), F.lit(False))
        placed.where(late).drop("__newest").write.mode("overwrite").parquet(f"{target}/late/batch={batch_id}")

        fresh = placed.where(~late).drop("__newest").withColumn("__new", F.lit(True))
        rows = fresh.unionByName(known.withColumn("__new", F.lit(False)))
        features = engineer_features(rows, config, columns, **ordering)
        done = features.where("__new").drop("__new")
        done.write.mode("overwrite").parquet(f"{target}/features/batch={batch_id}")

        state = _last_rows(rows.drop("__new"), columns, reach, keys, order, layout)
        state.write.mode("overwrite").parquet(_state_path(target, batch_id))
        batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def features_of(spark: SparkSession, target: str) -> DataFrame:
    """The rows with features that a feature stream wrote."""
    return _written(spark, target, "features", late=False)


def late_of(spark: SparkSession, target: str) -> DataFrame:
    """The rows that came too late."""
    return _written(spark, target, "late", late=True)


def _written(spark: SparkSession, target: str, folder: str, late: bool) -> DataFrame:
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/rows")
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.read.parquet(f"{target}/rows").where(F.col("__late") == late).drop("__late")
    return spark.read.parquet(f"{target}/{folder}").drop("batch")


def _state_path(target: str, batch_id: int) -> str:
    """Two folders in turn: the state a batch reads stays until the next batch is written."""
    return f"{target}/state/turn={batch_id % 2}"


def _read_state(spark: SparkSession, target: str, batch_id: int, like: DataFrame) -> DataFrame:
    if batch_id == 0:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(_state_path(target, batch_id - 1))


def _last_rows(
    rows: DataFrame, columns: list[str], reach: int, keys: list[str], order: list[str], layout: Layout
) -> DataFrame:
    filled = over_rows(
        rows,
        lambda frame: {f"__last_{c}": frame.filled(c) for c in columns},
        order_by=order,
        partition_by=keys,
        fill={c: value(rows, c) for c in columns},
        layout=layout,
    )
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").desc() for c in order])
    kept = filled.withColumn("__age", F.row_number().over(newest_first)).where(F.col("__age") <= reach + 1)
    carried = {c: F.when(F.col("__age") > reach, F.col(f"`__last_{c}`")).otherwise(F.col(f"`{c}`")) for c in columns}
    return kept.withColumns(carried).select(*rows.columns)
