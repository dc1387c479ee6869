import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewatch.sources.ingest import METADATA_FIELDS, ingest_tables
from tidewatch.sources.staging import stage, staging_root
from tidewatch.sources.synthetic import DAYS, synthetic_series
from tidewatch.sources.tables import load_csv, load_ingested, load_parquet, processed_path, save_csv, save_parquet


def test_generated_kinds(spark):
    admissions = synthetic_series(spark, "site_admissions", truth=True)
    assert admissions.count() == DAYS
    assert admissions.where("planted").count() == int(DAYS * 0.05)
    assert admissions.agg(F.min("admissions")).first()[0] >= 0
    occupancy = synthetic_series(spark, "bed_occupancy")
    low, high = occupancy.agg(F.min("occupancy_rate"), F.max("occupancy_rate")).first()
    assert 0 <= low and high <= 100
    icu = synthetic_series(spark, "icu_utilization")
    assert icu.columns == ["date", "region", "hospital_id", "icu_beds_used", "icu_beds_total", "icu_utilization_rate"]
    assert icu.where("icu_beds_total != 25 OR icu_utilization_rate NOT BETWEEN 0 AND 100").isEmpty()
    assert str(icu.agg(F.max("date")).first()[0])[:10] == "2023-12-31"
    assert synthetic_series(spark, "other").columns == ["date", "region", "hospital_id"]


def test_generator_is_reproducible_and_bumps_stand_out(spark):
    first, second = (synthetic_series(spark, "admissions", truth=True) for _ in range(2))
    assert first.exceptAll(second).isEmpty()
    means = {r["planted"]: r["m"] for r in first.groupBy("planted").agg(F.avg("admissions").alias("m")).collect()}
    assert 20 < means[True] - means[False] < 40


def test_ingest_writes_raw_processed_and_metadata(spark, tmp_path):
    messy = spark.createDataFrame([("2023-01-02", 5, float("nan"))], "date string, `Bed Count` int, `Fill-Rate` double")
    out = ingest_tables(spark, {"beds": messy}, str(tmp_path), "site", {"beds": {"provider": "mock", "url": "u"}})
    assert out["beds"].columns == messy.columns
    processed = load_parquet(spark, processed_path(str(tmp_path), "site", "beds"))
    assert processed.dtypes == [("date", "timestamp_ntz"), ("bed_count", "int"), ("fill_rate", "double")]
    assert processed.first()["fill_rate"] is None
    (part,) = (tmp_path / "raw" / "site" / "beds_metadata.json").glob("*.json")
    meta = json.loads(part.read_text())
    assert set(meta) <= set(METADATA_FIELDS)
    assert {"source", "dataset_id", "retrieval_date", "provider"} <= set(meta)
    assert load_ingested(spark, ["beds"], str(tmp_path), "site")["beds"].count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_ingested(spark, ["absent"], str(tmp_path), "site")
    with pytest.raises(ValueError):
        ingest_tables(spark, {}, str(tmp_path))


def test_nanosecond_files(spark, tmp_path):
    when = pd.Timestamp("2020-02-03 04:05:06.123456")
    data = pa.table({"date": pa.array([when.value, None], pa.timestamp("ns")), "x": [1.0, float("nan")]})
    pq.write_table(data, tmp_path / "ns.parquet", version="2.6")
    rows = load_parquet(spark, str(tmp_path / "ns.parquet"), nanosecond_columns=["date"]).collect()
    assert rows[0]["date"] == when.to_pydatetime() and rows[1]["date"] is None and rows[1]["x"] is None


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 1.5), (2, None, None)], "n int, s string, x double")
    for _ in range(2):  # the second write replaces the first
        save_parquet(df, str(tmp_path / "p"))
        save_csv(df, str(tmp_path / "c"), single_file=True)
    assert load_parquet(spark, str(tmp_path / "p")).exceptAll(df).isEmpty()
    assert load_csv(spark, str(tmp_path / "c")).collect() == df.collect()
    assert load_csv(spark, str(tmp_path / "c"), schema=df.schema).dtypes == df.dtypes
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    ingested = ingest_tables(spark, {"from_csv": str(tmp_path / "c" / "*.csv")}, str(tmp_path))
    assert ingested["from_csv"].count() == 2


def test_staged_tables_live_in_the_shared_folder(spark):
    df = stage(spark.range(3).toDF("n"), "probe")
    assert df.count() == 3
    assert df.inputFiles()[0].removeprefix("file://").startswith(staging_root(spark).removeprefix("file:"))


def test_ingest_passes_reader_settings(spark, tmp_path):
    (tmp_path / "semi.csv").write_text("day;n\n1;007\n2;\n")
    reading = {"semi": {"schema": "day int, n string", "sep": ";"}}
    out = ingest_tables(spark, {"semi": str(tmp_path / "semi.csv")}, str(tmp_path / "root"), reading=reading)
    assert sorted(map(tuple, out["semi"].collect())) == [(1, "007"), (2, None)]
