"""Every registered query against its comparison SQL, on the smallest driver tables.

The plans must hold no Python and no cross join.
"""

import os

import pytest

import __spark_entry__ as entry
from isobar.plans.catalog import QUERIES
from tests.compare import compare, sql_engine
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return sql_engine(FOLDER)


def no_python_and_no_cross_join(df):
    text = plan(df)
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    # Ten suppliers are too few for some queries to have rows; sf0.01 has them.
    found = compare(spark, con, name, FOLDER, True, no_python_and_no_cross_join)
    assert found == []


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
