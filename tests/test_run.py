import copy

import pytest

from tidewatch.functions.columns import NOTEBOOK_EXCLUDED, feature_columns
from tidewatch.operators.forest import ForestModel
from tidewatch.operators.ordered import SPREAD
from tidewatch.operators.quality import QualityError
from tidewatch.plans.anomaly_run import DEFAULT_CONFIG, run_anomaly_detection
from tidewatch.sources.synthetic import synthetic_series
from tidewatch.sources.tables import load_csv

KINDS = ("site_admissions", "bed_occupancy", "icu_utilization")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    tables = {k: synthetic_series(spark, k) for k in KINDS}
    return root, run_anomaly_detection(spark, tables, str(root), source="demo", layout=SPREAD)


def test_shapes_of_the_default_run(run):
    _, result = run
    assert list(result.datasets) == list(KINDS)
    assert set(result.quality.status.values()) == {"passed"}
    assert len(result.features.columns) == 68
    assert len(result.model.features) == 58 == len(feature_columns(result.features))
    assert len(feature_columns(result.features, NOTEBOOK_EXCLUDED)) == 62
    assert result.features.dropna(subset=result.model.features).count() == 1796
    assert result.predictions.count() == 1826
    assert set(result.evaluation) == {"persistence", "top_anomalies", "seasonality", "stability"}
    summary = result.summary.first()
    assert summary["rows"] == 1826 and 0.03 < summary["anomaly_rate"] < 0.07


def test_written_results(spark, run):
    root, result = run
    assert load_csv(spark, str(root / "results" / "anomalies.csv")).count() == 20
    assert spark.read.parquet(str(root / "results" / "features.parquet")).count() == 1826
    assert ForestModel.load(spark, str(root / "results" / "isolation_forest")) == result.model
    overlay = spark.read.parquet(str(root / "results" / "report" / "series_with_anomalies"))
    assert overlay.groupBy("metric").count().count() == 3
    assert (root / "results" / "qc_report.json").exists()


def test_switches_and_failures(spark, tmp_path):
    config = copy.deepcopy(DEFAULT_CONFIG)
    config["output"] = {"save_predictions": False, "save_features": False, "save_figures": False}
    config["isolation_forest"]["n_estimators"] = 5
    config["features"]["partition_by"] = ["region"]
    tables = {"icu": synthetic_series(spark, "icu", days=200)}
    result = run_anomaly_detection(spark, tables, str(tmp_path / "a"), config)
    written = {p.name for p in (tmp_path / "a" / "results").iterdir()}
    assert written == {"qc_report.json", "isolation_forest"}
    assert result.predictions.count() == 200
    config["qc"]["required_columns"] = ["date", "ward"]
    with pytest.raises(QualityError, match="ward"):
        run_anomaly_detection(spark, tables, str(tmp_path / "b"), config)
