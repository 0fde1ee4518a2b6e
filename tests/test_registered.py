"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_answer_equals_sql(spark, db, folder, name):
    assert compare(spark, db, folder, name, QUERIES, ORACLES) == []


def test_every_check_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["lake_inventory", "lake_listing", "station_scores", "replay_scores"])
def test_rows_only_queries(spark, db, folder, name):
    assert compare(spark, db, folder, name, QUERIES, ORACLES) == []
