"""Every registered query against its SQL on the smallest tables."""

import glob

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return check.tables(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    result, _ = check.compare(spark, duck, SF, name)
    assert result in ("equal", "rows")


def test_sql_has_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() >= 100
