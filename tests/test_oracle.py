"""Every query that SQL can express gives the same names, types and rows on DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, sf_dir, name):
    assert differences(spark, duck, queries()[name], oracle_sql()[name], sf_dir) == []
