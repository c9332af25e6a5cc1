"""Every registered query that has SQL gives the same rows as DuckDB."""

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL

FN, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, FN[name], SQL[name], SMALL) is None


def test_entry_has_one_row_per_fold_and_a_pooled_row(spark):
    rows = entry(spark).collect()
    assert sorted(r["fold"] for r in rows) == [-1, 0, 1, 2, 3, 4]
