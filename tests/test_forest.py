import math
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import tidewatch.operators.forest as forest_module
from tidewatch.operators.forest import ForestModel, IsolationForest, average_path
from tidewatch.plans.catalog.models import FIXED_FOREST

FEATURES = [f"feature_{i}" for i in range(5)]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(42)
    values = np.vstack([rng.normal(size=(950, 5)), rng.normal(size=(50, 5)) * 3 + 5])
    pdf = pd.DataFrame(values, columns=FEATURES)
    pdf["planted"] = np.arange(1000) >= 950
    pdf["id"] = np.arange(1000)
    return spark.createDataFrame(pdf.sample(frac=1, random_state=1))


@pytest.fixture(scope="module")
def model(matrix):
    return IsolationForest(n_estimators=50, contamination=0.1).fit(matrix, FEATURES, ["id"])


def by_id(df, name="anomaly_score"):
    return dict(df.select("id", name).collect())


def test_average_path():
    assert (average_path(1), average_path(2)) == (0.0, 1.0)
    assert average_path(256) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_labels_and_share(matrix, model):
    rows = model.get_anomalies(matrix).collect()
    assert {r["prediction"] for r in rows} <= {-1, 1}
    share = np.mean([r["is_anomaly"] for r in rows])
    assert 0.05 <= share <= 0.15
    assert all((r["prediction"] == -1) == r["is_anomaly"] for r in rows)
    assert all(-1 <= r["anomaly_score"] < 0 for r in rows)


def test_planted_rows_score_lowest(matrix, model):
    flagged = model.get_anomalies(matrix).where("is_anomaly")
    assert flagged.where("planted").count() >= 45


def test_threshold_moves_the_flag_only(matrix, model):
    plain = model.get_anomalies(matrix)
    strict = model.get_anomalies(matrix, threshold=-2.0)
    assert strict.where("is_anomaly").isEmpty()
    assert by_id(plain, "prediction") == by_id(strict, "prediction")


def test_refit_and_layout_do_not_matter(matrix, model):
    again = IsolationForest(n_estimators=50, contamination=0.1).fit(matrix.repartition(7, "planted"), FEATURES, ["id"])
    assert again.nodes == model.nodes
    assert again.offset == model.offset
    other = IsolationForest(n_estimators=50, contamination=0.1, random_state=7).fit(matrix, FEATURES, ["id"])
    assert other.nodes != model.nodes


def test_save_and_load(spark, matrix, model, tmp_path):
    model.save(spark, str(tmp_path / "model"))
    loaded = ForestModel.load(spark, str(tmp_path / "model"))
    assert loaded == model
    assert by_id(loaded.predict(matrix), "prediction") == by_id(model.predict(matrix), "prediction")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ForestModel.load(spark, str(tmp_path / "nothing"))


def test_trees_see_psi_distinct_rows(matrix):
    forest = IsolationForest(n_estimators=20, max_samples=64)
    drawn = forest.draw_samples(matrix)
    counts = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert len(counts) == 20 and all((r["n"], r["d"]) == (64, 64) for r in counts)
    small = IsolationForest(n_estimators=3, max_samples=5000).draw_samples(matrix)
    assert {r["count"] for r in small.groupBy("tree").count().collect()} == {1000}


def test_candidates_are_drawn_evenly(spark):
    """Every tree is full and no part of a large table is favoured."""
    rows = spark.range(200_000).select("id", (F.col("id") % 10).alias("part"))
    drawn = IsolationForest(n_estimators=40, max_samples=128).draw_samples(rows)
    assert [r[0] for r in drawn.groupBy("tree").count().select("count").distinct().collect()] == [128]
    parts = [r["count"] for r in drawn.groupBy("part").count().collect()]
    expected = 40 * 128 / 10
    assert len(parts) == 10 and all(abs(p - expected) < 6 * math.sqrt(expected) for p in parts)


@pytest.mark.parametrize("chunk", [1, 64])
def test_a_third_of_copies_is_sampled_as_a_third(spark, monkeypatch, chunk):
    """Rows that are equal are neither taken nor left as a whole, in chunks of few slots and of many."""
    monkeypatch.setattr(forest_module, "CHUNK_CANDIDATES", chunk)
    copies = F.col("id") < 1000
    rows = spark.range(3000).select(F.when(copies, -1).otherwise(F.col("id")).alias("id"), copies.cast("int").alias("copy"))
    drawn = IsolationForest(n_estimators=30, max_samples=20).draw_samples(rows)
    assert drawn.columns == ["id", "copy", "tree", "draw"]
    assert [r[0] for r in drawn.groupBy("tree").count().select("count").distinct().collect()] == [20]
    share = drawn.agg(F.avg("copy")).first()[0]
    assert abs(share - 1 / 3) < 0.1
    again = IsolationForest(n_estimators=30, max_samples=20).draw_samples(rows.repartition(5))
    assert again.exceptAll(drawn).isEmpty()


@pytest.mark.parametrize("parts", [1, 7])
def test_samples_do_not_depend_on_the_layout(spark, parts):
    forest = IsolationForest(n_estimators=20, max_samples=50)
    rows = spark.range(5000).select("id", (F.col("id") % 3).alias("x"))
    other = forest.draw_samples(rows.repartition(parts))
    assert other.exceptAll(forest.draw_samples(rows)).isEmpty()
    per_row = other.groupBy("id").count().agg(F.max("count")).first()[0]
    assert per_row <= 20 and other.count() == 20 * 50


def test_missing_and_infinite_inputs_take_the_mean(spark):
    rows = [(0, 1.0, 5.0), (1, None, 5.0), (2, float("nan"), 5.0), (3, float("inf"), 5.0), (4, 20.0, 5.0)]
    df = spark.createDataFrame(rows, "id int, value double, hour double")
    scores = by_id(FIXED_FOREST.score_samples(df))
    # The mean of "value" is 20.0 in the fixed forest.
    assert scores[1] == scores[2] == scores[3] == scores[4] != scores[0]


def test_columns_are_taken_by_name(spark):
    df = spark.createDataFrame([(0, 5.0, 30.0)], "id int, hour double, value double")
    turned = df.select("value", "id", "hour")
    assert by_id(FIXED_FOREST.score_samples(df)) == by_id(FIXED_FOREST.score_samples(turned))
    with pytest.raises(ValueError, match="hour"):
        FIXED_FOREST.score_samples(df.drop("hour"))


def test_large_forests_are_scored_in_parts(spark, matrix, model, monkeypatch):
    whole = by_id(model.score_samples(matrix))
    monkeypatch.setattr(forest_module, "TREES_PER_PART", 7)
    parts = by_id(model.score_samples(matrix))
    assert all(math.isclose(whole[k], parts[k], rel_tol=1e-12) for k in whole)


def test_nothing_to_train_on(spark):
    df = spark.createDataFrame([(1, None)], "id int, x double")
    with pytest.raises(ValueError, match="no complete rows"):
        IsolationForest().fit(df, ["x"], ["id"])


def test_incomplete_rows_are_scored_but_not_trained_on(spark, matrix):
    holes = matrix.withColumn("feature_0", F.when(F.col("id") >= 500, F.col("feature_0")))
    model, scored = IsolationForest(n_estimators=10, contamination=0.1).fit_score(holes, FEATURES, ["id"])
    assert scored.count() == 1000
    assert pc.max(model.nodes["size"]).as_py() == 256
    complete = [r[0] for r in scored.where("feature_0 IS NOT NULL").select("anomaly_score").collect()]
    assert model.offset == pytest.approx(np.quantile(complete, 0.1))


def test_worker_code_needs_no_installed_package(tmp_path):
    """Python workers of a cluster may not have this package."""
    (tmp_path / "grow.pkl").write_bytes(cloudpickle.dumps(forest_module._grow_tree))
    script = (
        "import pickle, numpy as np; grow = pickle.load(open('grow.pkl', 'rb'));"
        "print(len(grow(0, np.arange(8.0).reshape(8, 1), 3, 1)))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) >= 3
