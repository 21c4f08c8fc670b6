"""Every registered query against its SQL, over whole tables of the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from goldthread.plans.registry import ORACLES, QUERIES
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert problem in (None, "no rows on either side")


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["src_id", "component_root", "group_size"] and df.count() == 150
    assert df.select("component_root").distinct().count() == 57
