import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.features import engineer_features
from tidewatch.operators.ordered import DAILY, SPREAD, Layout
from tidewatch.plans.catalog.models import FIXED_FOREST
from tidewatch.streaming.incremental import feature_stream, features_of, late_of
from tidewatch.streaming.monitor import append_available, daily_anomaly_rates, read_parquet_stream, score_stream

SCHEMA = "id bigint, ts timestamp_ntz, value double, hour double"


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i) if i % 5 else None, float(i % 24)) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    for part in range(4):
        df.where(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), df


def test_windowed_rates_over_several_batches(spark, folder, tmp_path):
    path, df = folder
    out = daily_anomaly_rates(spark, path, df.schema, "ts", F.col("value") > 60, value_cols=["value"])
    got = {r["window_start"]: (r["rows"], r["anomalies"], r["value_missing"]) for r in out.collect()}
    want = {
        r["d"]: (r["n"], r["a"], r["m"])
        for r in df.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("value") > 60).alias("a"), F.count_if(F.col("value").isNull()).alias("m"))
        .collect()
    }
    assert got == want


def test_stream_scores_equal_batch_scores(spark, folder, tmp_path):
    path, df = folder
    stream = read_parquet_stream(spark, path, df.schema, maxFilesPerTrigger=1)
    out = append_available(score_stream(stream, FIXED_FOREST), str(tmp_path / "out"), str(tmp_path / "cp"))
    batch = FIXED_FOREST.get_anomalies(df)
    assert out.select(batch.columns).exceptAll(batch).isEmpty() and out.count() == 100


def test_repeated_ids_stay_and_one_file_is_a_table(spark, folder, tmp_path):
    _, df = folder
    twice = df.union(df.where("id < 3"))
    twice.coalesce(1).write.parquet(str(tmp_path / "once"))
    file = str(next((tmp_path / "once").glob("part-*.parquet")))
    for name, path in (("a", str(tmp_path / "once")), ("b", file)):
        stream = score_stream(read_parquet_stream(spark, path, df.schema), FIXED_FOREST)
        assert append_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp")).count() == 103


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_do_not_depend_on_the_zone(spark, folder, zone):
    path, df = folder
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = daily_anomaly_rates(spark, path, df.schema, "ts", F.col("value") > 60)
        starts = sorted(r["window_start"] for r in out.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert starts == [dt.datetime(2024, 1, d) for d in range(1, 6)]


CONFIG = {"features": {"rolling_windows": [3, 5], "lag_features": [1, 4]}}


@pytest.mark.parametrize("layout", [DAILY, Layout(block_rows=8)])
def test_stream_features_equal_batch_features(spark, tmp_path, layout):
    """Files arrive in order of time; series pause, and gaps outlast the kept rows."""
    rows = []
    for i in range(160):
        key = "hot" if i % 3 else "ab"[i // 3 % 2]
        rows.append((i, key, float(i * i % 17) if i % 29 == 0 or key != "hot" else None))
    schema = "n bigint, series string, x double"
    df = spark.createDataFrame(rows, schema)
    for part in range(4):
        df.where(F.col("n").between(part * 40, part * 40 + 39)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    target = str(tmp_path / "out")
    ordering = {"order_by": ["n"], "partition_by": ["series"]}
    query = feature_stream(
        stream, CONFIG, ["x"], **ordering, target=target, checkpoint=str(tmp_path / "cp"), available_now=True, layout=layout
    )
    query.awaitTermination()
    got = features_of(spark, target)
    want = engineer_features(df, CONFIG, ["x"], **ordering, layout=DAILY)
    assert got.count() == 160
    assert _text(got, want.columns) == _text(want, want.columns)
    assert late_of(spark, target).isEmpty()


def test_odd_values_on_keyed_streams(spark, tmp_path):
    """Zeros, infinities, NaN, whole numbers and gaps give what the batch operator gives, over four batches."""
    odd = [0.0, 1.0, None, float("nan"), float("inf"), float("inf"), -2.5, 0.0, 0.0, None, float("-inf"), 7.0]
    rows = [(i, f"s{i % 7}", odd[(i * 5 + i // 7) % 12], None if i % 11 == 0 else i % 5, "kept") for i in range(200)]
    df = spark.createDataFrame(rows, "n bigint, series string, x double, k int, other string")
    for part in range(4):
        df.where(F.col("n").between(part * 50, part * 50 + 49)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ordering = {"order_by": ["n"], "partition_by": ["series"], "layout": DAILY}
    target = str(tmp_path / "out")
    feature_stream(stream, CONFIG, ["x", "k"], **ordering, target=target, checkpoint=str(tmp_path / "cp"), available_now=True).awaitTermination()
    got, want = features_of(spark, target), engineer_features(df, CONFIG, ["x", "k"], **ordering)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert _text(got, want.columns) == _text(want, want.columns)


def _text(df, columns):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(columns).collect())


@pytest.mark.parametrize("layout", [DAILY, SPREAD])
def test_late_rows_are_kept_aside(spark, tmp_path, layout):
    schema = "n bigint, series string, x double"
    source = str(tmp_path / "in")
    for rows in ([(5, "a", 1.0)], [(3, "a", 2.0), (6, "a", 3.0), (1, "b", 4.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        feature_stream(
            stream,
            CONFIG,
            ["x"],
            order_by=["n"],
            partition_by=["series"],
            target=str(tmp_path / "out"),
            checkpoint=str(tmp_path / "cp"),
            available_now=True,
            layout=layout,
        ).awaitTermination()
    target = str(tmp_path / "out")
    assert [r["n"] for r in late_of(spark, target).collect()] == [3]
    lags = {(r["series"], r["n"]): r["x_lag_1"] for r in features_of(spark, target).collect()}
    assert lags == {("a", 5): None, ("a", 6): 1.0, ("b", 1): None}
    with pytest.raises(ValueError, match="look ahead"):
        feature_stream(stream, {"features": {"lag_features": [-1]}}, ["x"], order_by=["n"], partition_by=["series"], target="", checkpoint="")
