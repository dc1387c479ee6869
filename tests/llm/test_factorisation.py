import math

import numpy as np
import pytest
from llm_odd import DATA, ODD, table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import factorisation as fm
from tidewatch.llm.catalog import op11_quality_classifier


@pytest.fixture(scope="module")
def machine(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return fm.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"), metadata=("n_chars",))


def by_hand(machine, text, more):
    """The score with all pairs written out."""
    counts, statistics = fm.words_and_statistics(text)
    places, values = machine.vector(counts, [*statistics, *more])
    assert len(set(places.tolist())) == len(places)
    total = machine.bias + machine.weights[places] @ values
    for i in range(len(places)):
        for j in range(i + 1, len(places)):
            total += machine.vectors[places[i]] @ machine.vectors[places[j]] * values[i] * values[j]
    return 1 / (1 + math.exp(-total))


def test_sum_of_squares_is_all_pairs(spark, machine):
    texts = ["", None, "One short text, of words.", "#### ||| 1234", "a b " * 300, "Mixed É漢字🙂 text\nwith lines\n\nwith lines"]
    more = np.array([[3.0], [np.nan], [0.0], [7.0], [9.5], [100.0]])
    got = machine.scores(texts, more)
    assert np.allclose(got, [by_hand(machine, t, m) for t, m in zip(texts, more)], atol=1e-9)
    assert np.allclose(got, [machine.scores([t], m[None])[0] for t, m in zip(texts, more)])


def test_words_of_one_place_add_up():
    counts = {b"w%d" % k: 1 + k % 3 for k in range(4000)}
    places, values = fm.word_part(counts)
    assert (np.diff(places) > 0).all() and abs(values @ values - 1) < 1e-9
    again = fm.word_part(dict(reversed(counts.items())))
    assert (again[0] == places).all() and (again[1] == values).all()


def test_held_out_rows(spark):
    """Rows whose labels were never read: nearly all are scored right, good ones above bad ones."""
    got = op11_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert len(good) > 50 and len(bad) > 5
    assert (good[:, None] > bad[None]).mean() > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    """Turning round every held-out label changes no score."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (fm.train(docs, t.where(~held)) for t in (labels, turned))
    assert one.bias == two.bias and (one.vectors == two.vectors).all()


def test_layout_does_not_matter(spark, machine):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(7)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").repartition(3)
    again = fm.train(docs, labels, metadata=("n_chars",))
    assert again.bias == machine.bias and (again.weights == machine.weights).all() and (again.vectors == machine.vectors).all()


def test_copies_count_once(spark, table):
    """A text of many copies and a text of one give the machine one row each."""
    labels = spark.createDataFrame([(k, 1 if k else 0) for k in range(60)], "doc_id bigint, quality int")
    words, _, y = fm.training_rows(table(["rare text"] + ["common text"] * 59), labels)
    assert sorted(y) == [0.0, 1.0]
    words, _, y = fm.training_rows(table([f"text {k}" for k in range(60)]), labels, most_rows=7)
    assert len(y) == 7
    words, _, y = fm.training_rows(table([f"text {k}" for k in range(60)]), labels, most_features=10)
    assert sum(len(w[0]) for w in words) == 10


def test_odd_texts_and_labels(spark, table):
    docs = table([*ODD, "1 " * 500_000], [*range(8), None, 8])
    labels = spark.createDataFrame([(0, 1), (3, 0), (3, 1), (None, 1), (4, None), (99, 0)], "doc_id bigint, quality int")
    machine = fm.train(docs, labels)
    got = fm.score(docs, machine).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[5] == scores[6] and scores[0] == scores[1]
    assert fm.score(docs.where("false"), machine).count() == 0
    untrained = fm.train(docs, labels.where("false"), metadata=("class",))
    assert {r["score"] for r in fm.score(docs, untrained, metadata=("class",)).collect()} == {0.5}
    missing = fm.score(docs.withColumn("class", F.lit(None).cast("int")), untrained, metadata=("class",))
    assert missing.count() == 10
