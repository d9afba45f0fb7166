"""Hot keys: the ways around them give the same rows as the plain form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.operators import ordering, skew, windows
from tests.conftest import rows


@pytest.fixture(scope="module")
def hot(spark):
    """900 of 1200 rows on one key; days repeat, ties are told apart by id."""
    rng = random.Random(3)
    data = []
    for i in range(1200):
        key = "hot" if i % 4 else f"s{i % 16}"
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(120))
        data.append((key, day, i, None if i % 9 == 0 else round(rng.uniform(10, 30), 1), day.year))
    return spark.createDataFrame(
        data, "station_id string, observation_date date, id long, sea_surface_temp double, year int"
    )


def test_split_hot_loses_nothing(hot):
    cold, warm = skew.split_hot(hot, ["station_id"], 100)
    assert {r[0] for r in warm.select("station_id").distinct().collect()} == {"hot"}
    assert rows(cold.unionByName(warm)) == rows(hot)
    assert skew.split_hot(hot, ["station_id"], 10_000)[1] is None


def test_null_keys_can_be_hot(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1)], "k string, v int")
    cold, warm = skew.split_hot(df, ["k"], 10)
    assert (cold.count(), warm.count()) == (1, 50)


@pytest.mark.parametrize("keys", [["station_id"], []])
def test_numbered_is_row_number(hot, keys):
    order = [F.col("observation_date"), F.col("id")]
    got = skew.numbered(hot, keys, order).select("id", "pos")
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*order)
    want = hot.select("id", F.row_number().over(w).cast("long").alias("pos"))
    assert rows(got) == rows(want)


def _brute(hot, back):
    """Direct reading of the frame: the mean of the `back` rows before."""
    groups = {}
    for r in hot.where("sea_surface_temp IS NOT NULL").collect():
        groups.setdefault(r.station_id, []).append(r)
    out = []
    for rs in groups.values():
        rs.sort(key=lambda r: (r.observation_date, r.id))
        for i, r in enumerate(rs):
            past = [p.sea_surface_temp for p in rs[max(0, i - back) : i]]
            out.append((r.id, r.sea_surface_temp - sum(past) / len(past) if past else None))
    return dict(out)


@pytest.mark.parametrize("limit,block", [(10**9, 100), (100, 64), (100, 7), (0, 1000)])
def test_anomaly_of_hot_stations(hot, limit, block):
    got = windows.sst_anomaly(
        hot, ["id"], 2020, back=20, max_group_rows=limit, block_rows=block
    ).collect()
    want = _brute(hot, 20)
    assert len(got) == len(want)
    for r in got:
        if want[r.id] is None:
            assert r.sst_anomaly is None
        else:
            assert abs(r.sst_anomaly - want[r.id]) <= 0.00501


def test_salted_avg_is_the_plain_one(hot):
    got = skew.salted_avg(hot, ["station_id"], "sea_surface_temp", ["id"], 8)
    want = hot.groupBy("station_id").agg(
        F.count("*").alias("n"),
        F.sum("sea_surface_temp").alias("total"),
        F.avg("sea_surface_temp").alias("mean"),
    )
    for a, b in zip(rows(got), rows(want)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2]) and a[3] == pytest.approx(b[3])


def test_salted_avg_of_nulls(spark):
    df = spark.createDataFrame([("a", None, 1)], "k string, v double, i int")
    assert rows(skew.salted_avg(df, ["k"], "v", ["i"])) == [("a", 1, None, None)]


def _newest_first(hot):
    data = hot.collect()
    return [r.id for r in sorted(data, key=lambda r: (-r.observation_date.toordinal(), r.station_id, r.id))]


@pytest.mark.parametrize("k", [1, 50, 700, 1200, 5000])
def test_newest_by_day_counts(hot, monkeypatch, k):
    monkeypatch.setattr(ordering, "HEAP_ROWS", 10)
    got = [r.id for r in ordering.newest(hot, k, ["station_id", "id"]).collect()]
    assert got == _newest_first(hot)[:k]


@pytest.mark.parametrize("number,day_rows", [(1, 10**6), (4, 10**6), (12, 10**6), (13, 10**6), (5, 0)])
def test_far_pages(hot, monkeypatch, number, day_rows):
    monkeypatch.setattr(ordering, "HEAP_ROWS", 10)
    got = ordering.page(hot, ["station_id", "id"], number, 100, max_day_rows=day_rows)
    assert [r.id for r in got.collect()] == _newest_first(hot)[(number - 1) * 100 : number * 100]


@pytest.mark.parametrize("number", [1, 7, 13])
def test_pages_of_any_order(hot, monkeypatch, number):
    monkeypatch.setattr(ordering, "HEAP_ROWS", 10)
    order = [F.desc("station_id"), F.asc("id")]
    got = [r.id for r in ordering.page_by(hot, order, number, 100).collect()]
    want = [r.id for r in hot.orderBy(*order).collect()]
    assert got == want[(number - 1) * 100 : number * 100]


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("day_rows", [10**6, 0])
def test_split_by_time(hot, fraction, day_rows):
    got = ordering.split_by_time(hot, fraction, ["station_id", "id"], max_day_rows=day_rows)
    side = {r.id: r.split for r in got.collect()}
    order = _newest_first(hot)
    cut = int(len(order) * fraction)
    assert [side[i] for i in order] == ["train"] * cut + ["test"] * (len(order) - cut)


def test_split_with_undated_rows(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2)), (2, dt.date(2020, 1, 1)), (3, None), (4, None)],
        "id int, observation_date date",
    )
    side = {r.id: r.split for r in ordering.split_by_time(df, 0.75, ["id"]).collect()}
    assert side == {1: "train", 2: "train", 3: "train", 4: "test"}


def test_bucketed_pair_keeps_hot_keys_apart(spark, hot):
    from isobar.operators import joins
    from isobar.session import work_table
    from isobar.sources import tables

    fact = hot.select("station_id", F.col("sea_surface_temp").alias("temp_mean"))
    dim = hot.select("station_id").distinct().withColumns(
        {"country": F.upper("station_id"), "region": F.lit("R")}
    )
    f, d, apart = tables.bucketed_pair(
        fact, dim, "station_id", work_table("hf"), work_table("hd"), 4, max_key_rows=100
    )
    assert apart.count() == 900 and f.count() == 300
    got = rows(joins.country_region_bucketed(f, d, apart))
    want = rows(joins.country_region_shuffle(fact, dim))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
