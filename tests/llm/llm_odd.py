"""Texts that operators must survive, and tables with column names that the operators use themselves."""

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, words string, `row` string, class int, hits string, spaced string"


@pytest.fixture
def table(spark):
    """Documents from texts, numbered from 0 or by the given ids."""

    def make(texts, ids=None, partitions=3):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "w", None, 7, "h", "s") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions)

    return make


#: Empty, missing, blank, very long, repeated and odd texts.

ODD = [
    "",
    None,
    " \n\t ",
    "word",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2,
    "same text here",
    "same text here",
    "é漢字🙂 ÀÉ   x\u0001y",
    "long " * 30_000,
]
