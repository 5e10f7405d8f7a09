import sys, os
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every query with SQL gives that SQL's rows; every query runs."""

import pytest

import __spark_entry__
from helpers import assert_same, connect

SQL = {k: v for k, v in __spark_entry__.oracle_sql().items() if not k.startswith("op")}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert_same(con, SQL[name], __spark_entry__.queries()[name](spark, sf_dir))


def test_every_reference_query_has_sql():
    assert {k for k in __spark_entry__.queries() if k[0] in "qtckximr"} == set(SQL)


def test_entry(spark, sf_dir):
    got = __spark_entry__.entry(spark)
    assert got.columns == __spark_entry__.queries()["q02_game_pace"](spark, sf_dir).columns and got.count() > 0
