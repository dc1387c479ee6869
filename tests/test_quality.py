import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.quality import (
    Bound,
    QualityError,
    check_seasonality,
    configured_bounds,
    covers_date_range,
    date_extent,
    date_monotonic,
    discovered_bounds,
    missing_ratios,
    missing_threshold,
    missingness,
    numeric_bounds,
    quality_table,
    required_columns,
    summary_stats,
    table_profile,
)
from tidewatch.plans.quality_run import run_quality_checks


@pytest.fixture(scope="module")
def clean(spark):
    rng = np.random.default_rng(3)
    rows = [
        (
            dt.datetime(2023, 1, 1 + i),
            str(rng.choice(["North", "South", "East"])),
            f"H{rng.integers(1, 4):03d}",
            int(rng.integers(20, 100)),
            float(rng.uniform(60, 95)),
            int(rng.integers(5, 20)),
        )
        for i in range(31)
    ]
    return spark.createDataFrame(
        rows,
        "date timestamp_ntz, region string, hospital_id string, admissions bigint, occupancy_rate double,"
        " icu_beds_used bigint",
    )


@pytest.fixture(scope="module")
def dirty(clean):
    n = F.dayofmonth("date")
    return clean.select(
        "date",
        "region",
        F.when(n == 6, -10).when(n.between(16, 21), None).otherwise(F.col("admissions")).cast("double").alias("admissions"),
        F.when(n == 11, 120.0).otherwise(F.col("occupancy_rate")).alias("occupancy_rate"),
    )


def test_required_columns(clean, spark):
    assert required_columns(clean, ["date", "region"])["passed"]
    narrow = spark.createDataFrame([(1, 2)], "date bigint, value bigint")
    with pytest.raises(QualityError) as error:
        required_columns(narrow, ["date", "region", "hospital_id"])
    assert "region" in str(error.value) and "hospital_id" in str(error.value)


def test_dates_ascend_after_sorting(spark, clean):
    text = spark.createDataFrame([("2023-01-05", 1), ("2023-01-03", 2), ("2023-01-01", 3)], "date string, value bigint")
    assert date_monotonic(text)["passed"]
    assert date_monotonic(clean, group_cols=["region", "hospital_id"])["passed"]
    with pytest.raises(QualityError):
        date_monotonic(text.drop("date"))


def test_missing_dates_are_found_per_group(spark):
    rows = [(None, "a"), (dt.datetime(2023, 1, 1), "a"), (dt.datetime(2023, 1, 1), "b"), (None, None)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, region string")
    assert not date_monotonic(df)["passed"]
    result = date_monotonic(df, group_cols=["region"])
    assert not result["passed"]
    assert [tuple(r) for r in result["non_monotonic_groups"].collect()] == [("a", 1)]


def test_bounds(dirty):
    bounds = configured_bounds(dirty, {"admissions": {"min": 0}, "occupancy_rate": {"min": 0, "max": 100}, "nope": {"min": 0}})
    found = {r["column"]: r for r in numeric_bounds(dirty, bounds).collect()}
    assert set(found) == {"admissions", "occupancy_rate"}
    assert (found["admissions"]["type"], found["admissions"]["count"]) == ("below_minimum", 1)
    assert found["occupancy_rate"]["type"] == "above_maximum"
    assert found["occupancy_rate"]["percentage"] == pytest.approx(100 / 31)


def test_bounds_without_violation_or_column(clean):
    assert numeric_bounds(clean, configured_bounds(clean, {"admissions": {"min": 0}})).isEmpty()
    assert numeric_bounds(clean, configured_bounds(clean, {"unknown": {"min": 0}})).isEmpty()


def test_bounds_by_name(spark, clean):
    assert discovered_bounds(clean) == [
        Bound("admissions", low=0),
        Bound("occupancy_rate", low=0, high=100),
        Bound("icu_beds_used", low=0),
    ]
    config = {"admissions": {"min": 50}}
    assert "admissions" not in [b.column for b in discovered_bounds(clean, config)]
    assert config == {"admissions": {"min": 50}}
    shares = spark.createDataFrame([(1.2, 80.0), (0.5, 90.0)], "occupancy double, occupancy_pct double")
    assert [r["column"] for r in numeric_bounds(shares, discovered_bounds(shares)).collect()] == ["occupancy"]


def test_nan_breaks_no_bound(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert numeric_bounds(df, [Bound("x", low=0, high=10)]).isEmpty()


def test_missingness(clean, dirty):
    assert set(missingness(clean).values()) == {0.0}
    assert missingness(dirty)["admissions"] == pytest.approx(6 / 31)
    assert {r["column"] for r in missing_ratios(dirty).where("ratio > 0").collect()} == {"admissions"}
    with pytest.raises(QualityError, match="admissions"):
        missingness(dirty, threshold=0.1, fail_on_threshold=True)
    missingness(dirty, threshold=6 / 31, fail_on_threshold=True)


def test_threshold_lookup():
    assert missing_threshold({}) == 0.3
    assert missing_threshold({"processing": {"missing_threshold": 0.2}}) == 0.2
    assert missing_threshold({"qc": {"missing_threshold": 0.1}, "processing": {"missing_threshold": 0.2}}) == 0.1


def test_seasonality_ties_take_the_earlier_month(spark):
    rows = [(dt.datetime(2023, m, 1), v) for m, v in ((1, 5.0), (2, 9.0), (3, 9.0), (4, 5.0))]
    row = check_seasonality(spark.createDataFrame(rows, "date timestamp_ntz, x double"), "date", "x").first()
    assert (row["peak_month"], row["trough_month"]) == (2, 1)
    assert row["coefficient_of_variation"] == pytest.approx(np.std([5, 9, 9, 5], ddof=1) / 7)


def test_date_range(clean):
    assert covers_date_range(clean, "date", "2023-01-01", "2023-01-31")
    assert not covers_date_range(clean, "date", "2022-12-31", "2023-01-31")
    assert date_extent(clean).first()["last_date"] == dt.datetime(2023, 1, 31)


def test_profile_and_summary(clean):
    profile = table_profile(clean).first()
    assert (profile["row_count"], profile["column_count"]) == (31, 6)
    stats = {r["column"]: r for r in summary_stats(clean).collect()}
    values = [r[0] for r in clean.select("admissions").collect()]
    assert stats["admissions"]["q50"] == np.median(values)
    assert stats["admissions"]["std"] == pytest.approx(np.std(values, ddof=1))


def test_quality_table_of_an_empty_table(clean):
    rows = {(r["check"], r["metric"], r["column"]): r for r in quality_table(clean.limit(0), "none", {}).collect()}
    assert rows["profile", "row_count", None]["value"] == 0
    assert rows["missingness", "ratio", "date"]["value"] is None


def read_json(path):
    return [json.loads(line) for p in sorted(path.glob("*.json")) for line in p.read_text().splitlines()]


def test_run_passes_and_writes_the_report(spark, clean, tmp_path):
    config = {
        "qc": {
            "required_columns": ["date", "region"],
            "date_monotonic_group_by": ["region", "hospital_id"],
            "missing_threshold": 0.3,
            "numeric_bounds": {"admissions": {"min": 0}},
            "check_outliers": True,
        },
        "date_range": {"start": "2023-01-01", "end": "2023-01-31"},
    }
    result = run_quality_checks(spark, {"clean": clean}, config, str(tmp_path / "report"))
    assert result.status == {"clean": "passed"}
    assert result.groups["clean"].isEmpty()
    checks = {r["check"] for r in result.report.collect()}
    assert checks == {"profile", "required_columns", "date_monotonic", "missingness", "numeric_bounds", "date_range", "outliers"}
    (written,) = read_json(tmp_path / "report")
    assert written["dataset_id"] == "clean" and written["status"] == "passed" and len(written["checks"]) > 10


def test_violations_do_not_fail_a_dataset(spark, dirty):
    result = run_quality_checks(spark, {"dirty": dirty}, {"qc": {"fail_fast": True}})
    assert result.status == {"dirty": "passed"}
    broken = {(r["column"], r["metric"]) for r in result.report.where("NOT passed").collect()}
    assert ("admissions", "below_minimum") in broken and ("occupancy_rate", "above_maximum") in broken


def test_fail_fast_still_writes_the_report(spark, clean, tmp_path):
    config = {"qc": {"required_columns": ["date", "region", "hospital_id"], "fail_fast": True}}
    with pytest.raises(QualityError, match="region"):
        run_quality_checks(spark, {"bad": clean.drop("region"), "good": clean}, config, str(tmp_path / "report"))
    (written,) = read_json(tmp_path / "report")
    assert written["status"] == "failed" and "region" in written["error"]


def test_without_fail_fast_all_tables_are_checked(spark, clean, dirty):
    config = {"qc": {"fail_fast": False, "fail_on_missing_threshold": True, "missing_threshold": 0.1}}
    result = run_quality_checks(spark, {"dirty": dirty, "clean": clean}, config)
    assert result.status == {"dirty": "failed", "clean": "passed"}
    assert "admissions" in result.errors["dirty"]
