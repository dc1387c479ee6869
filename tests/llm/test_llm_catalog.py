"""Every registered query of the package that has SQL, against it."""

import pytest
from check import compare, connect
from llm_odd import DATA

from __spark_entry__ import oracle_sql, queries
from tidewatch.llm.catalog import QUERIES, SQL

#: What SQL cannot express is compared with brute force elsewhere.
NO_SQL = {"op1_licenses", "op2_bpe", "op3_token_files", "op4_pii", "op11_quality_classifier", "op12_alignment"}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_registered():
    assert set(QUERIES) - set(SQL) == NO_SQL and not set(SQL) - set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, DATA).toPandas(), con.execute(SQL[name]).df()) == ""
