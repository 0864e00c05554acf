"""Each query against the answer DuckDB gives on the same tables."""

import pytest
from oracle import connect, duck_rows, spark_rows

from casecast.oracles import ORACLES
from casecast.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck, ORACLES[name])
    spark.catalog.clearCache()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark, monkeypatch, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert sum(row.n for row in rows) == 812
