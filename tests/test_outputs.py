"""Summaries and windows brought up to date by parts, against working everything out again."""

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators.windows import rolling_precip
from isobar.plans import summaries
from isobar.session import work_path, work_table
from isobar.sources import tables
from tests.conftest import rows

COLUMNS = "k long, region string, station_id long, observation_date date, year int, month int, temp_mean double, precipitation double"


@pytest.fixture(scope="module")
def obs(spark):
    rng = np.random.default_rng(1)
    out = []
    for k in range(1500):
        day = dt.date(2000, 1, 1) + dt.timedelta(days=int(rng.integers(0, 3 * 365)))
        region = [None, "E", "W's"][int(rng.integers(0, 3))]
        temp = None if k % 11 == 0 else float(rng.integers(-5, 5))
        out.append((k, region, int(rng.integers(0, 4)), day, day.year, day.month, temp, float(rng.integers(0, 900)) / 100))
    df = spark.createDataFrame(out, COLUMNS)
    path = work_path(spark, "obs")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def state(spark, s):
    spark.catalog.refreshTable(s.table)
    table = spark.table(s.table).where("rows > 0")
    return rows(table.select(*sorted(table.columns)))


def worked_out(df, s):
    out = summaries.partials(df, s)
    return rows(out.select(*sorted(out.columns)))


def test_state_follows_every_change(spark, obs):
    s = summaries.Summary(work_table("t_state"))
    now = obs.where("k < 900")
    summaries.create(now, s)
    assert state(spark, s) == worked_out(now, s)
    # Rows come.
    later = obs.where("k < 1200")
    summaries.change(spark, s, later, added=obs.where("k >= 900 AND k < 1200"))
    assert state(spark, s) == worked_out(later, s)
    # Extremes go, and other values come in their place.
    hottest = obs.where("k < 1200 AND temp_mean >= 3")
    cooler = hottest.withColumn("temp_mean", F.col("temp_mean") - 4)
    now = obs.where("k < 1200 AND (temp_mean < 3 OR temp_mean IS NULL)").unionByName(cooler)
    summaries.change(spark, s, now, added=cooler, removed=hottest)
    assert state(spark, s) == worked_out(now, s)
    # A whole year goes: its groups are empty, and may fill again.
    year = F.col("year") == 2001
    summaries.change(spark, s, now.where(~year), removed=now.where(year))
    assert state(spark, s) == worked_out(now.where(~year), s)
    summaries.change(spark, s, now, added=now.where(year))
    assert state(spark, s) == worked_out(now, s)
    summaries.rebuild(obs.where(year), s)
    assert state(spark, s) == worked_out(now.where(~year).unionByName(obs.where(year)), s)


def test_a_change_rewrites_only_its_partitions(spark, obs):
    s = summaries.Summary(work_table("t_state"), keys=("station_id", "year"), measures=("temp_mean",))
    summaries.create(obs, s)
    files = lambda y: {r[0] for r in spark.table(s.table).where(f"year = {y}").select("_metadata.file_path").distinct().collect()}
    before = {y: files(y) for y in (2000, 2001, 2002)}
    more = obs.where("year = 2001").limit(5)
    summaries.change(spark, s, obs.unionByName(more), added=more)
    spark.catalog.refreshTable(s.table)
    assert files(2000) == before[2000] and files(2002) == before[2002] and not files(2001) & before[2001]


def published(spark, obs):
    name = work_table("t_out")
    tables.write_warehouse(obs, name, ("year", "region"), None, fmt="parquet")
    names = summaries.Outputs(name, summaries.Summary(f"{name}_s"), f"{name}_r", f"{name}_c")
    summaries.publish_outputs(spark, names)
    return names


def outputs(spark, names):
    for t in (names.summary.table, names.rolling, names.change):
        spark.catalog.refreshTable(t)
    rolled = spark.table(names.rolling).select("station_id", "observation_date", "rolling_precip")
    return state(spark, names.summary), rows(rolled), rows(spark.table(names.change).select("region", "month", "year", "avg_temp", "change"))


@pytest.mark.parametrize("kept", ["true", "region = 'E' AND month < 12"])
def test_reloaded_year_reaches_the_next(spark, obs, kept):
    """Also where the year loses a region and its last month."""
    names = published(spark, obs)
    again = obs.where("year = 2001").where(kept).withColumns(
        {"temp_mean": F.col("temp_mean") * 2 + 1, "precipitation": F.col("precipitation") + 3}
    )
    summaries.reload_year(spark, names, again, 2001)
    now = obs.where("year <> 2001").unionByName(again)
    got = outputs(spark, names)
    assert got[0] == worked_out(now, names.summary)
    assert got[1] == rows(rolling_precip(now))
    fresh = summaries.yearly_change(summaries.partials(now, names.summary))
    assert got[2] == rows(fresh.select("region", "month", "year", "avg_temp", "change"))
    assert rows(spark.table(names.published).select(*now.columns)) == rows(now)


def test_reload_keeps_files_out_of_reach(spark, obs):
    names = published(spark, obs)
    files = lambda t, w: {r[0] for r in spark.table(t).where(w).select("_metadata.file_path").distinct().collect()}
    far = "year = 2000 OR (year = 2002 AND month > 1)"
    before = files(names.rolling, far), files(names.change, "year = 2000"), files(names.published, "year <> 2001")
    summaries.reload_year(spark, names, obs.where("year = 2001"), 2001)
    for t in (names.rolling, names.change, names.published):
        spark.catalog.refreshTable(t)
    assert (files(names.rolling, far), files(names.change, "year = 2000"), files(names.published, "year <> 2001")) == before


def test_halo_is_read_by_date(spark, obs, monkeypatch):
    names, seen = published(spark, obs), []
    monkeypatch.setattr(summaries, "rolling_precip", lambda df, days: seen.append(formatted(df)) or rolling_precip(df, days))
    summaries.refresh_rolling(spark, spark.table(names.published), names.rolling, 2001)
    assert "GreaterThanOrEqual(observation_date,2000-12-03)" in seen[0] and "LessThanOrEqual(observation_date,2002-01-31)" in seen[0]
    assert "PartitionFilters: [isnotnull(year" in seen[0]


def formatted(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
