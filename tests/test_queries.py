"""Every registered query gives the rows, names and types of its SQL twin."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tidemark.plans.batch import BATCH_QUERIES
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.replays import REPLAY_QUERIES

# The optional operators test their queries themselves.
NAMES = sorted({**BATCH_QUERIES, **REPLAY_QUERIES})


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_twin(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_every_query_has_a_twin():
    assert set(ORACLE_SQL) == set(NAMES)
    assert set(NAMES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id"
    assert df.count() > 0
