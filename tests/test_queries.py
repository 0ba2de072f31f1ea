"""Every registered query beside its SQL text, on the smallest tables."""

from __future__ import annotations

import pytest

from datamill.operators import skew
from datamill.plans import catalog
from tools.check import database, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, connection, name):
    frame = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    problem = differences(frame, connection.execute(catalog.ORACLES[name]).df())
    assert problem is None or problem.startswith("OK"), problem


SPLIT_JOINS = [
    "alias_ratings", "chi_square_stats", "connected_components", "mean_auc_popularity", "path_length_histogram", "tfidf"
]


@pytest.mark.parametrize("name", SPLIT_JOINS)
def test_same_rows_when_hot_keys_are_split(spark, connection, monkeypatch, name):
    monkeypatch.setattr(skew, "SMALL_TABLE", 100)
    test_same_rows_as_sql(spark, connection, name)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_trained_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_reads_the_flagship_query(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())
