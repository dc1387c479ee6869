import datetime as dt

import pandas as pd
import pytest

from tidewatch.operators.evaluation import (
    anomaly_persistence,
    anomaly_runs,
    evaluate_anomalies,
    flag_rate,
    join_methods,
    method_overlap,
    persistence_rate,
    prior_years_month_mean,
    seasonal_distribution,
    stability_metrics,
)
from tidewatch.operators.fusion import fuse_tables
from tidewatch.operators.ordered import DAILY, Layout
from tidewatch.operators.ranking import top_anomalies, top_flagged, top_per_series
from tidewatch.operators.reports import anomaly_overlay, monthly_anomaly_rate, score_series, write_report_tables

LAYOUTS = [DAILY, Layout(block_rows=4)]
FLAGS = [True, True, False, False, True, False, True, True, True, False]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [(dt.datetime(2020, 1, 1) + dt.timedelta(days=i), f, -0.4 - 0.1 * f - 0.01 * i) for i, f in enumerate(FLAGS)]
    return spark.createDataFrame(rows, "date timestamp_ntz, is_anomaly boolean, anomaly_score double")


def test_top_k_breaks_ties_and_puts_missing_last(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 1.0), ("d", None), ("e", 2.0)], "k string, s double")
    assert [r["k"] for r in top_anomalies(df, "s", 2, tiebreak=["k"]).collect()] == ["b", "c"]
    assert [r["k"] for r in top_anomalies(df, "s", 9, ascending=False, tiebreak=["k"]).collect()] == list("aebcd")


def test_top_flagged_and_per_series(spark, flagged):
    top = top_flagged(flagged, "anomaly_score", ["date", "anomaly_score"], 2).collect()
    assert [r["date"].day for r in top] == [9, 8] and top[0].asDict().keys() == {"date", "anomaly_score"}
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 3.0), ("y", 9.0)], "k string, s double")
    ranked = {(r["k"], r["rank"]): r["s"] for r in top_per_series(df, "s", 2, partition_by=["k"]).collect()}
    assert ranked == {("x", 1): 1.0, ("x", 2): 2.0, ("y", 1): 9.0}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_persistence_counts_rows(flagged, layout):
    out = anomaly_persistence(flagged, window=3, layout=layout).orderBy("date")
    want = pd.Series(FLAGS).rolling(3, min_periods=1).sum().tolist()
    assert [r["anomaly_count_window"] for r in out.collect()] == want
    assert [r["persistent_anomaly"] for r in out.collect()] == [w > 1 for w in want]
    rate = persistence_rate(out).first()
    assert rate["persistence_rate"] == rate["persistent_anomalies"] / 6


def test_rate_of_nothing_is_missing(flagged):
    calm = anomaly_persistence(flagged.where("NOT is_anomaly"), layout=DAILY)
    assert persistence_rate(calm).first()["persistence_rate"] is None
    assert flag_rate(flagged).first()["anomaly_rate"] == 0.6


def test_seasonal_distribution(spark):
    rows = [(dt.datetime(2020, 1, 1), True), (dt.datetime(2020, 1, 2), False), (dt.datetime(2020, 2, 1), True), (None, True)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, is_anomaly boolean")
    got = {(r["grain"], r["key"]): (r["sum"], r["count"], r["mean"]) for r in seasonal_distribution(df).collect()}
    assert got == {("month", 1): (1, 2, 0.5), ("month", 2): (1, 1, 1.0), ("quarter", 1): (2, 3, pytest.approx(2 / 3))}
    assert {r["month"]: r["anomaly_rate"] for r in monthly_anomaly_rate(df).collect()} == {1: 0.5, 2: 1.0}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_stability(flagged, layout):
    got = stability_metrics(flagged, window=4, layout=layout).first()
    s = pd.Series([r["anomaly_score"] for r in flagged.orderBy("date").collect()])
    cv = s.rolling(4, min_periods=1).std() / s.rolling(4, min_periods=1).mean()
    want = {"mean_score": s.mean(), "std_score": s.std(), "cv_mean": cv.mean(), "cv_std": cv.std(), "score_range": s.max() - s.min()}
    for name, value in want.items():
        assert got[name] == pytest.approx(value)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_runs(flagged, layout):
    runs = [(r["run_start"].day, r["run_end"].day, r["run_length"]) for r in anomaly_runs(flagged, layout=layout).orderBy("run_start").collect()]
    assert runs == [(1, 2, 2), (5, 5, 1), (7, 9, 3)]


def test_run_over_many_blocks(spark):
    rows = [(i, i != 0, -1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "n int, is_anomaly boolean, anomaly_score double")
    out = anomaly_runs(df, order_by=["n"], layout=Layout(block_rows=5)).collect()
    assert [(r["run_start"], r["run_end"], r["run_length"]) for r in out] == [(1, 59, 59)]


def test_prior_years(spark):
    rows = [(dt.datetime(y, 1, d), float(v)) for y, d, v in ((2019, 1, 2), (2019, 2, 4), (2020, 1, 9), (2021, 1, 1))]
    out = prior_years_month_mean(spark.createDataFrame(rows, "date timestamp_ntz, x double"), "x").orderBy("year").collect()
    assert [(r["month_mean"], r["prior_mean"]) for r in out] == [(3.0, None), (9.0, 3.0), (1.0, 5.0)]


def test_methods_side_by_side(spark):
    a = spark.createDataFrame([(1, True), (2, True), (3, False)], "id int, is_anomaly boolean")
    b = spark.createDataFrame([(1, True), (2, False), (4, True)], "id int, is_anomaly boolean")
    joined = join_methods(a, b, ["id"])
    assert joined.count() == 4
    row = method_overlap(joined, "first_flag", "second_flag").first()
    assert (row["both"], row["only_first"], row["only_second"], row["overlap"]) == (1, 1, 1, pytest.approx(1 / 3))


def test_fusion_keeps_every_key_once(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (None, 1.0)], "k int, v double")
    b = spark.createDataFrame([(2, 7.0), (3, 8.0)], "k int, v double")
    out = {r["k"]: (r["a_v"], r["b_v"]) for r in fuse_tables({"a": a, "b": b}, ["k"]).collect()}
    assert out == {1: (3.0, None), 2: (5.0, 7.0), 3: (None, 8.0)}


def test_evaluation_tables(flagged):
    config = {"evaluation": {"top_k_anomalies": 3, "persistence_window": 2, "seasonality_check": False}}
    results = evaluate_anomalies(flagged, config, layout=DAILY)
    assert set(results) == {"persistence", "top_anomalies", "stability"}
    assert results["top_anomalies"].count() == 3
    assert set(evaluate_anomalies(flagged, {}, layout=DAILY)) == {"persistence", "top_anomalies", "seasonality", "stability"}


def test_report_tables(spark, flagged, tmp_path):
    long = anomaly_overlay(flagged.withColumnRenamed("anomaly_score", "load"), ["load", "absent"])
    assert long.columns == ["date", "is_anomaly", "metric", "value"] and long.count() == len(FLAGS)
    assert score_series(flagged, threshold=-0.5).first()["threshold"] == -0.5
    assert score_series(flagged).first()["threshold"] is None
    paths = write_report_tables(flagged, ["anomaly_score"], str(tmp_path))
    assert [spark.read.parquet(p).count() for p in paths] == [10, 10, 1]
