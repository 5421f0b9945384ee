"""Every registered query against its checking SQL on the smallest data set."""

import pytest
from compare import compare, connect
from conftest import DATA

import __spark_entry__ as entry

# Without rows on the smallest data: too few users, no two sessions in one second, no peaks. Anything else must have some.
MAY_BE_EMPTY = {
    "a20_users_for_training",
    "j1_conflict_pairs",
    "j1_conflict_pairs_lock",
    "m31_peaks",
    "m33_recommendations",
    "st8_conflict_pairs_stream",
}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, key):
    status, detail = compare(entry.queries()[key](spark, DATA), con, entry.oracle_sql()[key])
    assert status == "ok" or (status == "EMPTY" and key in MAY_BE_EMPTY), detail


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_yields_rows(spark, key):
    assert entry.queries()[key](spark, DATA).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
