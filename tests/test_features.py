import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.calendar import parse_date, seasonal_features
from tidewatch.functions.columns import feature_columns, metric_columns, numeric_columns, snake_case_names, widest_table
from tidewatch.functions.missing import divide, drop_incomplete
from tidewatch.operators.features import difference_features, engineer_features, lag_features, rolling_features
from tidewatch.operators.ordered import DAILY, SPREAD, ROW, Layout, index_rows

EDGE = [1.0, None, 3.0, 0.0, 5.0, 0.0, 0.0]
LAYOUTS = [DAILY, Layout(block_rows=3)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(list(enumerate(EDGE)), "n int, x double")


def column(df, name, order="n"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None and w is None) or (g is not None and w is not None and math.isclose(g, w, abs_tol=1e-5)), (got, want)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_relative_change_carries_values_over_gaps(edge, layout):
    out = difference_features(edge, ["x"], order_by=["n"], layout=layout)
    close(column(out, "x_pct_change_1"), [None, 0.0, 2.0, -1.0, math.inf, -1.0, None])
    close(column(out, "x_diff_1"), [None, None, None, -3.0, 5.0, -5.0, 0.0])


def test_relative_change_without_fill(edge):
    out = difference_features(edge, ["x"], order_by=["n"], fill="none", layout=DAILY)
    close(column(out, "x_pct_change_1"), [None, None, None, -1.0, math.inf, -1.0, None])
    with pytest.raises(ValueError):
        difference_features(edge, ["x"], order_by=["n"], fill="linear")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_rolling_statistics(edge, layout):
    out = rolling_features(edge, ["x", "absent"], [3], order_by=["n"], layout=layout)
    close(column(out, "x_rolling_mean_3"), [1, 1, 2, 1.5, 2.66667, 1.66667, 1.66667])
    close(column(out, "x_rolling_std_3"), [None, None, 1.41421, 2.12132, 2.51661, 2.88675, 2.88675])
    assert "absent_rolling_mean_3" not in out.columns


def test_min_periods_gate(edge):
    full = rolling_features(edge, ["x"], [2], order_by=["n"], min_periods=None, layout=DAILY)
    close(column(full, "x_rolling_min_2"), [None, None, None, 0.0, 0.0, 0.0, 0.0])
    none_needed = rolling_features(edge, ["x"], [1], order_by=["n"], min_periods=0, layout=DAILY)
    close(column(none_needed, "x_rolling_max_1"), EDGE)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, 5.0)], "n int, x double")
    out = rolling_features(df, ["x"], [3], order_by=["n"], layout=DAILY)
    close(column(out, "x_rolling_max_3"), [1.0, 1.0, 5.0])
    close(column(out, "x_rolling_mean_3"), [1.0, 1.0, 3.0])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_lags_and_leads(edge, layout):
    out = lag_features(edge, ["x"], [1, 2, -1], order_by=["n"], layout=layout)
    assert column(out, "x_lag_1") == [None, *EDGE[:-1]]
    assert column(out, "x_lag_2") == [None, None, *EDGE[:-2]]
    assert column(out, "x_lag_-1") == [*EDGE[1:], None]


def test_missing_order_keys_come_last(spark):
    df = spark.createDataFrame([("b", None, 3.0), ("a", 1, 1.0), ("c", 2, 2.0)], "k string, n int, x double")
    for layout in LAYOUTS:
        out = lag_features(df, ["x"], [1], order_by=["n", "k"], layout=layout)
        assert column(out, "x_lag_1", "k") == [None, 2.0, 1.0]


@pytest.mark.parametrize("partition_by", [[], ["series"]])
def test_blocks_equal_pandas_with_a_hot_series(spark, partition_by):
    """One series holds most rows, one day a third of them; gaps reach across many blocks."""
    rng = np.random.default_rng(7)
    n = 900
    pdf = pd.DataFrame(
        {
            "series": rng.choice(["hot", "a", "b"], n, p=[0.8, 0.15, 0.05]),
            "day": np.where(rng.random(n) < 0.34, 50, rng.integers(0, 100, n)),
            "id": rng.permutation(n),
            "x": np.where(rng.random(n) < 0.9, np.nan, rng.normal(10, 3, n).round(2)),
        }
    )
    df = spark.createDataFrame(pdf).repartition(5)
    config = {"features": {"rolling_windows": [3, 9], "lag_features": [1, 5, -2]}}
    out = engineer_features(
        df,
        config,
        ["x"],
        order_by=["day", "id"],
        partition_by=partition_by,
        layout=Layout(block_rows=40),
    )
    got = out.toPandas().sort_values("id", ignore_index=True)

    ordered = pdf.sort_values([*partition_by, "day", "id"])
    groups = [g for _, g in ordered.groupby("series")] if partition_by else [ordered]
    parts = []
    for g in groups:
        g = g.copy()
        for w in (3, 9):
            r = g["x"].rolling(w, min_periods=1)
            for stat in ("mean", "std", "min", "max"):
                g[f"x_rolling_{stat}_{w}"] = getattr(r, stat)()
        for lag in (1, 5, -2):
            g[f"x_lag_{lag}"] = g["x"].shift(lag)
        g["x_diff_1"] = g["x"].diff()
        g["x_pct_change_1"] = g["x"].ffill() / g["x"].ffill().shift() - 1
        parts.append(g)
    want = pd.concat(parts).sort_values("id", ignore_index=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False, atol=1e-9)


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 5000).alias("k")).repartition(6)
    out = index_rows(df, ["k"]).toPandas()
    assert sorted(out[ROW]) == list(range(5000))
    assert (out.sort_values(ROW)["k"].diff().dropna() == 1).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "n int, x double")
    for layout in LAYOUTS:
        assert rolling_features(df, ["x"], [3], order_by=["n"], layout=layout).count() == 0


def test_seasonal_features(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2021-01-01",)], "date string")
    rows = {str(r["date"])[:10]: r for r in seasonal_features(df).collect()}
    first, second = rows["2024-01-01"], rows["2021-01-01"]
    assert (first["day_of_week"], first["quarter"], first["day_of_year"]) == (0, 1, 1)
    assert second["week_of_year"] == 53
    assert math.isclose(first["month_sin"], math.sin(2 * math.pi / 12))
    assert math.isclose(first["dow_cos"], 1.0)


def test_unreadable_dates_raise(spark):
    df = spark.createDataFrame([("not a date",)], "date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        parse_date(df).collect()


def test_engineered_columns(spark, day):
    df = spark.createDataFrame([(day(i), float(i % 13)) for i in range(60)], "date timestamp_ntz, value double")
    config = {"features": {"rolling_windows": [7], "lag_features": [1, 7], "seasonal_features": True}}
    out = engineer_features(df, config, ["value"], layout=SPREAD)
    assert {"month", "month_sin", "value_rolling_mean_7", "value_lag_1", "value_lag_7", "value_diff_1"} <= set(out.columns)
    assert out.count() == 60
    assert column(out, "value_lag_1", "date")[:2] == [None, 0.0]


def test_column_discovery(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1, True, "a")], "unit_id int, load double, covid_cases int, flag boolean, region string"
    )
    assert numeric_columns(df) == ["unit_id", "load", "covid_cases"]
    assert metric_columns(df) == ["load"]
    assert feature_columns(df.withColumn("load_outlier", F.lit(True))) == ["unit_id", "load", "covid_cases", "flag"]
    assert widest_table({"a": df, "b": df.withColumn("z", F.lit(1)), "c": df.withColumn("y", F.lit(1))}) == "b"
    assert snake_case_names(df.withColumnRenamed("load", "Bed Load-Rate")).columns[1] == "bed_load_rate"
    with pytest.raises(ValueError, match="collide"):
        snake_case_names(df.toDF("a b", "a-b", "c", "d", "e"))


def test_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(divide(F.col("a"), F.col("b"))).collect()] == [math.inf, -math.inf, None, 1.5]


def test_complete_rows_keep_infinities(spark):
    df = spark.createDataFrame([(1, math.inf), (2, math.nan), (3, None), (4, 1.0)], "n int, x double")
    assert [r["n"] for r in drop_incomplete(df).orderBy("n").collect()] == [1, 4]


@pytest.mark.parametrize("layout", [DAILY, Layout(block_rows=50)])
def test_wide_windows_equal_sliding_frames(spark, monkeypatch, layout):
    """Gaps, infinities of both signs, constant stretches and whole numbers, with windows beyond a series and of odd widths."""
    from tidewatch.operators import evaluation, features

    rows = []
    for i in range(900):
        x = None if i % 13 == 0 else float("inf") if i == 300 else float("-inf") if i in (330, 700) else 1e6 + i % 7
        rows.append((i, "ab"[i % 3 == 0], 5.25 if 400 < i < 650 else x, i % 11 if i % 4 else None, i % 5 == 0))
    df = spark.createDataFrame(rows, "n int, series string, x double, k int, flag boolean")
    how = {"order_by": ["n"], "partition_by": ["series"], "layout": layout}

    def made():
        rolled = features.rolling_features(df, ["x", "k"], [1, 2, 3, 31, 64, 100], min_periods=2, **how)
        return rolled, evaluation.anomaly_persistence(df, "flag", 40, **how), evaluation.rolling_cv(df, "k", 37, **how)

    plain = made()
    for module in (features, evaluation):
        monkeypatch.setattr(module, "WIDE", 0)
    for want, got in zip(plain, made()):
        assert got.columns == want.columns and got.schema == want.schema
        for a, b in zip(want.orderBy("n").collect(), got.orderBy("n").collect()):
            for c in want.columns:
                assert a[c] == b[c] or a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-6), (c, a, b)
