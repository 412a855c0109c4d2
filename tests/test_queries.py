"""Every query of the tables, loads and reads against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from quotelake.catalog import analysis, records, writes
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for group in (records, writes, analysis) for name, query in group.QUERIES.items()}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    rows, problem = compare(df, entry.oracle_sql()[name], SF)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 20
