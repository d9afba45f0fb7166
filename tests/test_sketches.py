"""Stored sketches, and both sides of a split as bounded frames."""

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import model, ordering, sketches
from isobar.session import work_path, work_table
from tests.conftest import rows


def full_plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def obs(spark):
    rng = np.random.default_rng(4)
    data = [
        (["E", "W"][k % 2], 2000 + k % 5, int(rng.zipf(1.5)) % 3000, float(rng.normal(k % 7, 3)))
        for k in range(40_000)
    ]
    data += [("N", 2003, 1, None), ("N", 2003, 1, float("nan"))]
    return spark.createDataFrame(data, "region string, year int, station_id long, temp_mean double")


def said(spark, table, obs, first, last):
    part = obs.where(f"year BETWEEN {first} AND {last}")
    for r in sketches.over_years(spark, table, first, last).collect():
        mine = part.where(F.col("region") == r.region)
        assert r.rows == mine.count()
        stations = mine.select("station_id").distinct().count()
        assert abs(r["keys"] - stations) <= sketches.COUNT_ERROR * stations
        temps = np.array([x[0] for x in mine.select("temp_mean").collect() if x[0] is not None and x[0] == x[0]])
        if not len(temps):
            assert r.median is None
            continue
        assert (temps < r.median).mean() <= 0.5 + sketches.RANK_ERROR and (temps <= r.median).mean() >= 0.5 - sketches.RANK_ERROR


def test_ranges_of_years_from_sketches(spark, obs):
    table = work_table("t_sketch")
    sketches.create(obs, table)
    for first, last in ((2000, 2004), (2001, 2002), (2003, 2003)):
        said(spark, table, obs, first, last)
    warmer = obs.where("year = 2002").withColumn("temp_mean", F.col("temp_mean") + 30)
    sketches.refresh(warmer, table)
    spark.catalog.refreshTable(table)
    said(spark, table, obs.where("year <> 2002").unionByName(warmer), 2001, 2003)
    assert sketches.over_years(spark, table, 1990, 1991).collect() == []
    text = full_plan(sketches.over_years(spark, table, 2001, 2002))
    assert "PartitionFilters: [isnotnull(year" in text and "temp_mean" not in text


@pytest.fixture(scope="module")
def days(spark):
    data = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=k % 9) if k % 10 else None, k % 12 + 1, float(k % 31), float(k % 7), float(k % 5)) for k in range(500)]
    df = spark.createDataFrame(data, "k long, observation_date date, month int, temp_mean double, humidity double, precipitation double")
    path = work_path(spark, "days")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.8, 0.9, 0.95, 1.0])
@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_frames_are_the_flagged_split(days, fraction, limit):
    flagged = ordering.split_by_time(days, fraction, ["k"], max_day_rows=limit)
    train, test = ordering.split_frames(days, fraction, ["k"], max_day_rows=limit)
    for side, name in ((train, "train"), (test, "test")):
        assert rows(side.select("k")) == rows(flagged.where(F.col("split") == name).select("k")), name


def test_whole_days_need_no_numbering(days):
    few = days.where("observation_date = DATE '2020-01-02' OR observation_date = DATE '2020-01-03'")
    n = few.groupBy("observation_date").count().orderBy(F.desc("observation_date")).collect()
    fraction = n[0]["count"] / (n[0]["count"] + n[1]["count"]) + 1e-9
    train, test = ordering.split_frames(few, fraction, [])
    assert {r[0] for r in train.select("observation_date").collect()} == {dt.date(2020, 1, 3)}
    assert {r[0] for r in test.select("observation_date").collect()} == {dt.date(2020, 1, 2)}


def test_sides_are_bounded_where_they_read(days, monkeypatch):
    seen = []
    plain = ordering.split_frames
    monkeypatch.setattr(model, "split_frames", lambda *a: seen.extend(plain(*a)) or tuple(seen[-2:]))
    out = model.train_and_evaluate(days, ["k"]).summary.first()
    assert out.train_size + out.test_size == 500
    train, test = (full_plan(x) for x in seen)
    assert "GreaterThan(observation_date," in train and "LessThan(observation_date," not in train
    assert "LessThan(observation_date," in test and "GreaterThan(observation_date," not in test
