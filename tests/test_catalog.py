"""Every registered query against the SQL that states its result."""

import pytest

from __spark_entry__ import entry
from check import compare, connect
from conftest import DATA

from tidewatch.plans.catalog import QUERIES, SQL

ROWS_ONLY = {"end_to_end_anomalies"}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql_or_is_known_not_to():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, DATA).toPandas(), con.execute(SQL[name]).df()) == ""


def test_entry(spark):
    rows = entry(spark)
    assert {"date", "region", "anomaly_score", "is_anomaly"} <= set(rows.columns)
    assert 0 < rows.where("is_anomaly").count() < rows.count()
