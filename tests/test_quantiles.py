import numpy as np
import pandas as pd
import pytest

from tidewatch.operators.outliers import detect_outliers, outlier_summary
from tidewatch.operators.quantiles import exact_quantiles, value_at_rank

PROBS = [0.0, 0.05, 0.25, 0.5, 0.9999, 1.0]


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(1)
    n = 4000
    hot = np.where(rng.random(n) < 0.34, 7.0, rng.normal(size=n) * 1e6)
    two_walls = np.where(rng.random(n) < 0.4999, 1.0, np.where(rng.random(n) < 0.99, 2.0, rng.random(n) + 1))
    return pd.DataFrame({"hot": hot, "walls": two_walls, "tail": rng.pareto(0.3, n), "void": [np.nan] * n})


@pytest.mark.parametrize(("exact_rows", "accuracy"), [(20, 50), (10**6, 100)])
def test_quantiles_are_exact(spark, awkward, exact_rows, accuracy):
    df = spark.createDataFrame(awkward)
    got = exact_quantiles(df, list(awkward), PROBS, exact_rows=exact_rows, accuracy=accuracy)
    assert got.pop("void") == [None] * len(PROBS)
    for name, values in got.items():
        np.testing.assert_allclose(values, awkward[name].quantile(PROBS), rtol=1e-12)


def test_value_at_rank(spark, awkward):
    df = spark.createDataFrame(awkward)
    ordered = np.sort(awkward["tail"])
    assert value_at_rank(df, "tail", 1234, exact_rows=10) == ordered[1234]
    assert value_at_rank(df, "tail", len(ordered)) is None


def test_first_quartile_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.25])["x"] == [1.75]


def test_outliers(spark):
    values = [10.0, 11.0, 9.0, 10.5, 9.5, 10.0, 100.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, x double")

    def flags(**kw):
        return [r[0] for r in detect_outliers(df, ["x", "absent"], **kw).orderBy("n").select("x_outlier").collect()]

    assert flags(method="zscore", threshold=2.0) == [False] * 6 + [True, False]
    assert flags(method="iqr", threshold=3.0) == [False] * 6 + [True, False]
    assert outlier_summary(df, 2.0, ["x"]).collect()[0]["outliers"] == 1
    with pytest.raises(ValueError, match="unknown outlier method"):
        detect_outliers(df, ["x"], method="lof")


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(1.0,)] * 3, "x double")
    assert not any(r["x_outlier"] for r in detect_outliers(df, ["x"]).collect())


@pytest.mark.parametrize(("exact_rows", "scans"), [(200_000, 2), (100, None)])
def test_two_scans_are_enough(spark, exact_rows, scans):
    """Rows read are counted by the source itself."""
    read = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch.assign(x=(batch["id"] * 7919 % 30011).astype(float), y=(batch["id"] % 3).astype(float))

    n = 30_000
    df = spark.range(n).mapInPandas(rows, "id long, x double, y double")
    got = exact_quantiles(df, ["x", "y"], [0.05, 0.25, 0.5, 0.95], exact_rows=exact_rows, accuracy=1000)
    ids = np.arange(n)
    for name, values in (("x", ids * 7919 % 30011), ("y", ids % 3)):
        np.testing.assert_allclose(got[name], np.quantile(values.astype(float), [0.05, 0.25, 0.5, 0.95]), rtol=1e-12)
    assert read.value == scans * n if scans else read.value > 2 * n
