"""Every registered query against its SQL, on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docferry.registry import ORACLES, QUERIES
from oracle import connect, differences


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, small, name):
    assert differences(queries()[name](spark, small), con, oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_gives_the_migrated_table(spark):
    df = entry(spark)
    assert df.columns == ["id", "_id", "created_at", "event_type", "props_k", "user_id", "value"]
    assert df.count() > 0
