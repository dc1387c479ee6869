import numpy as np
import pandas as pd
import pytest

from conftest import DATA

from tidewatch.operators.linear_ae import LinearAutoencoder, LinearAutoencoderModel, median_and_mad, time_split
from tidewatch.plans.anomaly_run import run_anomaly_detection
from tidewatch.plans.catalog import models
from tidewatch.sources.series import ship_daily


@pytest.fixture(scope="module")
def plane(spark):
    """Points near a plane in three dimensions, with a few far from it."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 400))
    c = a + b + rng.normal(size=400) * 0.05
    c[:10] += 4
    return spark.createDataFrame(pd.DataFrame({"id": range(400), "a": a, "b": b, "c": c}))


def test_error_is_the_distance_to_the_components(plane):
    model = LinearAutoencoder(encoding_dim=2, quantile=0.975).fit(plane, ["a", "b", "c"])
    got = model.predict(plane).toPandas().sort_values("id")
    x = got[["a", "b", "c"]].to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    axes = np.linalg.eigh(np.cov(z.T))[1][:, 1:]
    want = ((z - z @ axes @ axes.T) ** 2).sum(axis=1)
    np.testing.assert_allclose(got["reconstruction_error"], want, atol=1e-9)
    assert model.threshold == pytest.approx(np.quantile(want, 0.975))
    assert set(got.loc[got["is_anomaly"], "id"]) == set(range(10))
    assert set(got["prediction"]) == {-1, 1}


def test_robust_threshold_and_reload(spark, plane, tmp_path):
    model = LinearAutoencoder(encoding_dim=2, threshold="robust").fit(plane, ["a", "b", "c"])
    model.save(spark, str(tmp_path / "ae"))
    loaded = LinearAutoencoderModel.load(spark, str(tmp_path / "ae"))
    assert loaded.threshold == model.threshold
    a, b = (m.predict(plane).orderBy("id").select("reconstruction_error", "prediction").collect() for m in (model, loaded))
    assert a == b
    with pytest.raises(ValueError):
        LinearAutoencoder(threshold="magic").fit(plane, ["a"])
    with pytest.raises(ValueError, match="missing for scoring"):
        model.predict(plane.drop("a"))


def test_median_and_mad(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,), (None,)], "x double")
    assert median_and_mad(df, "x") == (3.0, 1.5)
    assert median_and_mad(df.limit(0), "x") == (None, None)


def test_time_split_keeps_the_order_of_time(spark, day):
    df = spark.createDataFrame([(day(i),) for i in range(100)], "date timestamp_ntz")
    train, validation = time_split(df, "date", 0.2)
    assert (train.count(), validation.count()) == (80, 20)
    assert train.agg({"date": "max"}).first()[0] < validation.agg({"date": "min"}).first()[0]


def test_threshold_from_the_earlier_rows(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), float(i % 7), float(i % 7) + (50.0 if i > 90 else 0.1 * (i % 3))) for i in range(100)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, a double, b double")
    model = LinearAutoencoder(encoding_dim=1).fit(df, ["a", "b"], date_col="date", validation_split=0.1)
    early = LinearAutoencoder(encoding_dim=1).fit(df.where("date < '2024-03-31'"), ["a", "b"])
    # Sums of other partitions may differ in the last bit.
    assert model.threshold == pytest.approx(early.threshold, rel=1e-9) and model.means == pytest.approx(early.means)
    assert model.predict(df).where("is_anomaly AND date > '2024-03-31'").count() >= 9


def test_end_to_end_takes_whole_tables(spark, monkeypatch):
    runs = []
    monkeypatch.setattr(models, "run_anomaly_detection", lambda *a, **k: runs.append(run_anomaly_detection(*a, **k)) or runs[0])
    out = models.end_to_end(spark, DATA)
    (run,) = runs
    assert run.datasets["shipping"].columns == ship_daily(spark, DATA).columns
    assert "avg_discount" in run.datasets["shipping"].columns
    assert {"region", "orders", "revenue"} <= set(out.columns) and out.count() > 0
