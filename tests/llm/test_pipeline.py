import corpus_pipeline
from llm_odd import DATA, ODD, table  # noqa: F401

from __spark_entry__ import queries
from tidewatch.sources.staging import stage


def test_stages_and_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, DATA), "test")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert tokens.count() == before
    again = queries()["pipeline"](spark, DATA)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, tokens.collect()))


def test_stages_survive_odd_and_empty_tables(spark, table):
    for docs in (table(ODD), table(ODD).where("false")):
        docs = docs.drop("hits").withColumnRenamed("words", "source")
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, DATA)
            out.write.format("noop").mode("overwrite").save()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()
