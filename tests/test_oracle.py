"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from recsift.plans.oracle import ORACLE
from recsift.plans.queries import QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    r = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert r["cols_ok"] and r["types_ok"], r["types"]
    assert r["spark_rows"] == r["sql_rows"], r
    assert r["values_ok"], (r["only_spark"], r["only_sql"])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item_i", "item_j", "co", "nor_i", "nor_j", "score"]
    assert df.count() > 0
