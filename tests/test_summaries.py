"""Joins, aggregates and windows on small literal frames."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import aggregates, joins, windows
from tests.conftest import rows

D = dt.date
STATIONS = [("a", "A", "KE", "East", True), ("b", "B", "ZA", "South", False), ("c", "C", "KE", "East", True)]


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(
        STATIONS, "station_id string, station_name string, country string, region string, is_active boolean"
    ).withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0)})


def obs(spark, data):
    """Rows of (station, date, temp_mean, precipitation, sst)."""
    return spark.createDataFrame(
        data,
        "station_id string, observation_date date, temp_mean double, precipitation double, sea_surface_temp double",
    ).select(
        "*",
        F.year("observation_date").alias("year"),
        F.month("observation_date").alias("month"),
        (F.col("temp_mean") + 1).alias("temp_max"),
        (F.col("temp_mean") - 1).alias("temp_min"),
        F.lit(50.0).alias("humidity"),
        F.lit(None).cast("double").alias("ocean_salinity"),
    )


@pytest.fixture(scope="module")
def fact(spark):
    return obs(
        spark,
        [
            ("a", D(2020, 1, 1), 10.0, 1.0, 20.0),
            ("a", D(2020, 1, 31), 20.0, None, 22.0),
            ("a", D(2021, 1, 1), 30.0, 2.0, None),
            ("b", D(2020, 2, 1), 5.0, 4.0, None),
            ("x", D(2020, 2, 1), 99.0, 9.0, None),
        ],
    )


def test_join_strategies_agree(fact, stations):
    want = [("KE", "East", 3, 20.0), ("ZA", "South", 1, 5.0)]
    assert rows(joins.country_region_broadcast(fact, stations)) == want
    assert rows(joins.country_region_shuffle(fact, stations)) == want


def test_active_only(fact, stations):
    assert rows(joins.country_year_sst(fact, stations)) == [("KE", 2020, 21.0), ("KE", 2021, None)]


def test_orphans(fact, stations):
    assert rows(joins.orphan_counts(fact, stations)) == [("kept", 4, 2), ("skipped", 1, 1)]
    kept, skipped = joins.split_known(fact, stations)
    assert (kept.count(), skipped.count()) == (4, 1)


def test_counts_keep_zeros(fact, stations):
    got = {r.station_id: r.observation_count for r in joins.station_counts(stations, fact).collect()}
    assert got == {"a": 3, "b": 1, "c": 0}


def test_regions_overview_keeps_empty_regions(spark, fact, stations):
    regions = spark.createDataFrame(
        [("East", "EAST", ""), ("South", "SOUTH", ""), ("North", "NORTH", "")], schemas.REGIONS
    )
    assert rows(aggregates.regions_overview(regions, stations, fact)) == [
        ("East", "EAST", 2, 3), ("North", "NORTH", 0, 0), ("South", "SOUTH", 1, 1),
    ]


def test_enrich_keeps_rows_without_baseline(spark, fact, stations):
    baselines = spark.createDataFrame([("East", 15.0)], schemas.BASELINES)
    got = joins.enrich(fact, stations, baselines)
    assert got.count() == 4
    assert {(r.station_id, r.temp_anomaly) for r in got.collect()} == {
        ("a", -5.0), ("a", 5.0), ("a", 15.0), ("b", None),
    }


def _brute_pairs(climate, ocean):
    return [
        (c[1], c[0], c[2], o[2])
        for c in climate
        for o in ocean
        if c[:2] == o[:2] and c[2] > 100 and o[2] < 33
    ]


def test_rain_and_salinity_describe_all_pairs(spark):
    climate = [(D(2020, 1, 1 + i % 3), "RS"[i % 2], 90.0 + i) for i in range(40)]
    ocean = [(D(2020, 1, 1 + i % 3), "RS"[i % 2], 32.0 + i / 20) for i in range(35)]
    got = joins.rain_vs_salinity(
        spark.createDataFrame(climate, "date date, region string, rainfall double"),
        spark.createDataFrame(ocean, "date date, region string, salinity double"),
    ).collect()
    pairs = _brute_pairs(climate, ocean)
    assert sum(r.pairs for r in got) == len(pairs)
    for r in got:
        mine = [p for p in pairs if p[:2] == (r.region, r.date)]
        assert r.pairs == len(mine)
        assert r.avg_rainfall == pytest.approx(statistics.mean(p[2] for p in mine))
        assert r.max_rainfall == max(p[2] for p in mine)
        assert r.avg_salinity == pytest.approx(statistics.mean(p[3] for p in mine))
        assert r.min_salinity == min(p[3] for p in mine)


def test_fact_by_fact_sums_all_pairs(fact):
    got = {r.station_id: r for r in joins.fact_by_fact(fact, fact, 2021).collect()}
    assert set(got) == {"a"}
    assert (got["a"].pairs, got["a"].sum_temp, got["a"].sum_precip) == (3, 90.0, 3.0)


def test_match_region(spark):
    regions = spark.createDataFrame(
        [("East Africa", "EAST", ""), ("Far lands", "REMOTE", "")], schemas.REGIONS
    )
    texts = spark.createDataFrame([("east AFRICA",), ("Remote",), ("none",), (None,)], "region_text string")
    got = {r.region_text: r.region_code for r in joins.match_region(texts, regions).collect()}
    assert got == {"east AFRICA": "EAST", "Remote": "REMOTE", "none": None, None: None}


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0, 1.0, 1.0, 5.0], [2.0, None, 4.0]])
@pytest.mark.parametrize("limit", [10**6, 0])
def test_exact_median(spark, values, limit):
    data = [("k", v) for v in values] + [(None, 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    want = statistics.median([v for v in values if v is not None])
    assert rows(aggregates.exact_median(df, ["k"], "v", limit)) == [("k", want), (None, 7.0)]


def test_exact_median_of_many_readings(spark):
    values = [((i * 7919) % 10_007) / 8 for i in range(5000)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    got = aggregates.exact_median(df, ["k"], "v", 100).first()
    assert got.median == statistics.median(values)


def test_region_stats_forms_agree(fact, stations):
    rows_ = fact.join(stations.select("station_id", "region"), "station_id")
    exact = {r.region: r for r in aggregates.region_stats(rows_, exact=True).collect()}
    sketch = {r.region: r for r in aggregates.region_stats(rows_).collect()}
    assert exact["East"].median_temp == sketch["East"].median_temp == 20.0
    # Humidity is constant here: no correlation, and no division by zero.
    assert exact["East"].humidity_precip_corr is None


def test_coverage(fact, stations):
    assert tuple(aggregates.coverage(fact, stations).first()) == (2, 2, 2, 2)
    assert tuple(aggregates.coverage(fact, stations, approximate=True).first()) == (2, 2, 2, 2)


def test_summary_counts_add_up(fact, stations):
    got = aggregates.region_summary(fact, stations).collect()
    assert sum(r.observation_count for r in got) == joins.split_known(fact, stations)[0].count()
    assert {r.region: r.station_count for r in got} == {"East": 1, "South": 1}


def test_pivot_fills_absent_regions_and_cuts_years(spark):
    data = [(y, "East Africa", 10.0 + y - 2000) for y in range(2000, 2012)] + [(2011, "West Africa", 40.0)]
    df = spark.createDataFrame(data, "year int, region string, temp_mean double")
    got = aggregates.anomaly_pivot(df).collect()
    assert [r.year for r in got] == list(range(2002, 2012))
    overall = statistics.mean(r[2] for r in data)
    assert got[-1].east == round(21.0 - overall, 1) and got[-1].west == round(40.0 - overall, 1)
    assert all(r.west == 0.0 for r in got[:-1]) and all(r.north == 0.0 for r in got)


def test_zero_average_stays_zero(spark):
    df = obs(spark, [("a", D(2020, 1, 1), 0.0, 0.0, 0.0)]).withColumn("region", F.lit("East"))
    assert aggregates.temp_trends(df, 2020, 2020).first().avg_temp_mean == 0.0
    assert aggregates.ocean_by_month(df).first().sst == 0.0


def test_dashboard_of_empty_tables(spark):
    empty_obs = spark.createDataFrame([], schemas.OBSERVATIONS)
    empty_st = spark.createDataFrame([], schemas.STATIONS)
    regions = spark.createDataFrame([], schemas.REGIONS)
    got = aggregates.dashboard_stats(empty_obs, empty_st, regions).first()
    assert (got.stations, got.observations, got.min_year, got.size_mb) == (0, 0, None, 0.0)


def test_year_over_year_needs_the_year_before(spark):
    data = [(y, 1, "R", t) for y, t in [(2000, 10.0), (2001, 12.0), (2003, 20.0)]]
    df = spark.createDataFrame(data, "year int, month int, region string, temp_mean double")
    got = {r.year: r.change for r in windows.year_over_year(df).collect()}
    assert got == {2000: None, 2001: 2.0, 2003: None}


def test_rolling_window_is_in_days(spark):
    days = [0, 1, 28, 29, 30, 31, 100]
    data = [("s", D(2020, 1, 1) + dt.timedelta(days=d), 1.0, 1.0, None) for d in days]
    got = [r.rolling_precip for r in windows.rolling_precip(obs(spark, data)).orderBy("observation_date").collect()]
    want = [float(sum(1 for e in days if d - 29 <= e <= d)) for d in days]
    assert got == want


def test_rolling_of_missing_rain(spark):
    got = windows.rolling_precip(obs(spark, [("s", D(2020, 1, 1), 1.0, None, None)])).first()
    assert got.rolling_precip is None


def test_anomaly_of_a_single_row_is_null(spark):
    got = windows.sst_anomaly(obs(spark, [("s", D(2020, 1, 1), 1.0, 1.0, 20.0)]), [], 2020).collect()
    assert [r.sst_anomaly for r in got] == [None]


def test_latest_and_recent(fact):
    order = [F.desc("observation_date")]
    got = {r.station_id: r.observation_date for r in windows.latest_per_key(fact, ["station_id"], order).collect()}
    assert got["a"] == D(2021, 1, 1) and len(got) == 3
    assert windows.recent_n(fact, ["station_id"], order, 2).where("station_id = 'a'").count() == 2


def test_request_stats_of_nothing(spark):
    log = spark.createDataFrame([], "user string, t double")
    assert tuple(aggregates.request_stats(log, "user", "t").first()) == (0, 0, None)


def test_request_stats_with_unknown_users(spark):
    log = spark.createDataFrame([("u", 1.0), (None, 2.0), ("u", None)], "user string, t double")
    assert tuple(aggregates.request_stats(log, "user", "t").first()) == (3, 1, 1.5)
