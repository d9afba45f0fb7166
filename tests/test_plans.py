"""Physical plans: what must be there, and what must not."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from isobar.operators import joins, windows
from isobar.plans.adapter import Inputs
from isobar.session import work_path, work_table
from isobar.sources import tables
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")

@pytest.fixture(scope="module")
def t(spark):
    return Inputs(spark, FOLDER)


def test_broadcast_join(t):
    text = plan(joins.country_region_broadcast(t.fact, t.stations))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    beyond = plan(joins.country_region_broadcast(t.fact, t.plain_stations, max_rows=1))
    assert "SortMergeJoin" in beyond


def test_shuffle_join(t):
    assert "SortMergeJoin" in plan(joins.country_region_shuffle(t.fact, t.plain_stations))


def test_bucketed_join_has_no_exchange(spark, t):
    fact, dim, hot = tables.bucketed_pair(
        t.fact.select("station_id", "temp_mean"),
        t.plain_stations.select("station_id", "country", "region"),
        "station_id",
        work_table("b_fact"),
        work_table("b_dim"),
    )
    assert hot is None
    joined = plan(fact.join(dim.hint("merge"), "station_id"))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    # The grouping that follows needs the only one.
    assert plan(joins.country_region_bucketed(fact, dim)).count("Exchange hash") == 1


def test_partition_pruning(spark, t):
    table = tables.write_warehouse(
        t.obs, work_table("pruned"), buckets=None, path=work_path(spark, "pruned")
    )
    from isobar.operators.filters import partition

    text = plan(partition(table, 1997, 6, "EUROPE"))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "region" in filters


def test_date_filters_reach_the_files(spark):
    text = plan(entry.queries()["filter_year_range"](spark, FOLDER))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThanOrEqual(l_shipdate" in pushed or "LessThan(l_shipdate" in pushed


def test_columns_are_pruned(spark):
    schema = plan(entry.queries()["year_trend"](spark, FOLDER)).split("ReadSchema: ")[1].split("\n")[0]
    assert "l_extendedprice" not in schema and "l_quantity" in schema


def test_limit_per_key_before_the_shuffle(t):
    text = plan(windows.recent_n(t.fact, ["station_id"], [F.desc("observation_date")], 3))
    below_exchange = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_facts_are_not_broadcast(spark):
    """The fact stays on the streamed side, however small the test table is."""
    for name in ("region_avg", "enrich_obs", "obs_with_station", "etl_enrich"):
        for part in plan(entry.queries()[name](spark, FOLDER)).split("BroadcastExchange")[1:]:
            first_scan = part.split("FileScan")[1] if "FileScan" in part else ""
            assert "l_suppkey" not in first_scan.split("\n")[0], name


def test_anomaly_takes_one_shuffle(t):
    assert plan(windows.sst_anomaly(t.fact, ["k1", "k2", "k3"], 1995)).count("Exchange hash") == 1
