"""The driver contract: entry smoke check and every query against its oracle."""

import pytest

import __spark_entry__ as E
from cellar.plans.queries import QUERIES
from compare import compare
from conftest import SF0001


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "seq", "raw_md5"]
    assert df.count() == 37


def test_keys_match():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF0001, name, E.queries()[name], E.oracle_sql()[name], verbose=True)
