"""Non-finite readings, NULL keys, repeated attributes, huge counts, limits and layouts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.functions.columns import finite, stable_round, units
from isobar.operators import aggregates, clean, filters, joins, ordering, upsert, windows
from isobar.plans import sync
from isobar.session import work_path, work_table
from isobar.sources import files, tables
from tests.conftest import plan, rows

MEASURES = ", ".join(f"{m} double" for m in schemas.MEASURES)


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-inf", "1e999", "abc"])
def test_text_that_is_no_finite_number_is_an_error(spark, text):
    raw = spark.createDataFrame(
        [("s", "n", "c", "r", text, "1", None, "yes", None)],
        "station_id string, station_name string, country string, region string, latitude string, "
        "longitude string, elevation string, is_coastal string, is_active string",
    )
    row = clean.coerce_stations(raw).first()
    assert row.errors == ["latitude is not a number"] and row.latitude is None
    obs = spark.createDataFrame([("s", "2020-01-02", None, None, text)], "station_id string, observation_date string, year string, month string, temp_mean string")
    row = clean.coerce_observations(obs).first()
    assert row.errors == ["temp_mean is not a number"] and row.temp_mean is None


def test_one_bad_reading_spoils_no_figure(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,), (3.0,)], "x double")
    assert rows(df.select(finite("x"))) == [(1.0,), (3.0,), (None,), (None,), (None,)]
    assert rows(df.select(units("x", 1))) == [(10,), (30,), (None,), (None,), (None,)]
    assert rows(df.select(stable_round("x", 2))) == [(1.0,), (3.0,), (None,), (None,), (None,)]
    file = tmp_path / "a.csv"
    file.write_text("x\n1.5\nNaN\n2.5\n")
    assert files.read_csv(spark, str(file), df.schema).agg(F.avg("x")).first()[0] == 2.0


def test_a_station_is_coastal_if_ever_a_sea_reading(spark):
    obs = spark.createDataFrame(
        [("s", "A", "c", "r", 1.0, 1.0, None), ("s", "B", "c", "r", 1.0, 1.0, 20.0), ("t", "T", "c", "r", 1.0, 1.0, None)],
        "station_id string, station_name string, country string, region string, latitude double, longitude double, sea_surface_temp double",
    )
    target = spark.createDataFrame([], "station_id string, station_name string, country string, region_code string, latitude double, longitude double, is_coastal boolean, is_active boolean, elevation double")
    regions = spark.createDataFrame([("r", "R", "")], schemas.REGIONS)
    got = sync.sync_stations(obs, target, regions).stations
    assert rows(got.select("station_id", "station_name", "is_coastal")) == [("s", "A", True), ("t", "T", False)]


def test_merging_a_frame_with_itself_changes_nothing(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0), ("a", None, 2.0), (None, None, 3.0)], "station_id string, observation_date date, v double")
    got = upsert.merge_flagged(df, df, ["station_id", "observation_date"], ["v"])
    assert rows(got.drop("action")) == rows(df) and rows(got.select("action")) == [("updated",)] * 3


def test_observations_without_a_date_are_skipped(spark):
    source = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), 2020, 1, *[1.0] * 7), ("a", None, None, None, *[1.0] * 7)],
        f"station_id string, observation_date date, year int, month int, {MEASURES}",
    )
    stations = spark.createDataFrame([("a",)], "station_id string")
    got = sync.sync_observations(source, source.where("false"), stations, [F.asc("temp_mean")])
    assert got.merged.count() == 1 and got.skipped.count() == 1


def test_pair_counts_beyond_a_bigint(spark):
    df = spark.createDataFrame([(4 * 10**9, 5 * 10**9)], "a long, b long")
    assert int(df.select(joins._product("a", "b")).first()[0]) == 20 * 10**18


def test_exports(spark):
    kinds = {"observation_date": "date", "station_id": "string", "station_name": "string", "country": "string", "region": "string"}
    cols = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in files.EXPORT_COLUMNS)
    days = [dt.date(2020, 1, 1 + i % 3) for i in range(1_500)]
    data = [(f"s{i:04}", "n", "KE" if i % 2 else "ZA", "r", d, *[1.0] * 7) for i, d in enumerate(days)]
    obs = spark.createDataFrame(data, cols)
    assert files.export_rows(obs).count() == 1_500
    assert files.export_rows(obs, {"country": "KE"}).count() == 750
    with pytest.raises(ValueError):
        files.export_rows(obs, cap=10)
    one, many = (files.export_rows(obs.repartition(n), {"country": "KE"}, 100, ["station_id"]) for n in (1, 7))
    assert rows(one) == rows(many) and one.count() == 100


def test_a_day_that_holds_all_rows_is_numbered(spark):
    df = spark.range(5_000).select(F.col("id"), F.lit(dt.date(2020, 1, 1)).alias("observation_date")).repartition(7)
    got = ordering.newest(df, 1_000, ["id"], max_day_rows=100)
    assert "RowNumber" not in plan(got) and [r.id for r in got.collect()] == list(range(1_000))
    undated = df.withColumn("observation_date", F.lit(None).cast("date"))
    assert [r.id for r in ordering.newest(undated, 10, ["id"], max_day_rows=100).collect()] == list(range(10))
    assert ordering.newest(df.where("false"), 10, ["id"]).count() == 0
    with pytest.raises(ValueError):
        ordering.split_by_time(df, 0.5, [])


def test_too_many_buckets_are_refused():
    with pytest.raises(ValueError):
        tables.buckets_for(10**15, 35)


def test_year_bounds_reach_the_files(spark):
    path = work_path(spark, "dated")
    df = spark.range(10).select(F.expr("date_add(DATE'1995-01-01', CAST(id AS INT) * 400)").alias("observation_date"), "id")
    df.write.parquet(path)
    obs = spark.read.parquet(path).withColumn("year", F.year("observation_date"))
    for got in (filters.year_range(obs, 1998), filters.year_range(obs, last=1998), filters.by_spec(obs, {"year__gte": 1998})):
        pushed = plan(got).split("PushedFilters:")[1].split("]")[0]
        assert "ThanOrEqual(observation_date" in pushed
    assert filters.by_spec(obs, {"year": 1998}).count() == filters.year_range(obs, 1998, 1998).count() > 0


def test_reloads_write_no_more_files_than_the_create(spark):
    df = spark.range(4_000).select(
        F.col("id").alias("station_id"), (F.col("id") % 5 + 1995).cast("int").alias("year"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("region"),
    )
    name, path = work_table("reload"), work_path(spark, "reload")
    tables.write_warehouse(df, name, buckets=4, path=path, fmt="parquet")
    count = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path).count()
    before = count()
    tables.overwrite_partitions(df.repartition(16), name)
    assert count() <= before and rows(spark.table(name)) == rows(df)
    tables.append_rows(df.repartition(16), name)
    assert count() <= 2 * before
    assert tables.bucket_spec(spark, name) == (4, "station_id")
    spark.sql(f"DROP TABLE {name}")


def test_years_that_differ_from_the_date(spark):
    rows = [
        ("a", "KE", "R", 2021, 1, None, 1.0, 20.0, 1.0), ("a", "KE", "R", 2021, 2, dt.date(2019, 5, 1), 1.0, 21.0, 1.0),
        ("a", "KE", "R", 2021, 3, dt.date(2021, 3, 1), 1.0, 22.0, 1.0), ("a", "KE", "R", 2019, 3, dt.date(2021, 3, 1), 1.0, 22.0, 1.0),
    ]
    obs = spark.createDataFrame(
        rows, "station_id string, country string, region string, year int, month int, observation_date date, "
        "temp_mean double, sea_surface_temp double, precipitation double",
    ).withColumns({c: F.lit(1.0) for c in ("temp_max", "temp_min", "ocean_salinity")})
    assert filters.by_spec(obs, {"year": 2021}).count() == 2
    assert filters.by_spec(obs, {"year": 2021}, date=None).count() == 3
    assert joins.fact_by_fact(obs, obs, 2021).first().pairs == 3 * 4
    assert windows.sst_anomaly(obs, [], 2021).count() == 3
    assert aggregates.monthly_summary(obs, 2021).count() == 3
