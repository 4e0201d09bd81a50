"""Every query that has SQL gives the same rows as the SQL on the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, duck

DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    diff, n = compare(entry.queries()[name](spark, DIR), con, SQL[name])
    assert diff == ""
    assert n > 0


#: Queries with another way for large tables, which small ones reach only if made to.
LARGE = ("tfidf_weights", "retrieve_topk", "recall_at_k", "quantile_edges", "drift_report", "drift_by_window")


@pytest.mark.parametrize("name", LARGE)
def test_matches_sql_the_way_of_large_tables(spark, con, monkeypatch, name):
    never = lambda *a: False
    for module in ("plans.skew", "operators.retrieval", "operators.matching", "queries.retrieval_queries"):
        monkeypatch.setattr(f"tandem.{module}.fits_broadcast", never)
    monkeypatch.setattr("tandem.operators.drift.SKETCH", 100)
    diff, n = compare(entry.queries()[name](spark, DIR), con, SQL[name])
    assert diff == "" and n > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
