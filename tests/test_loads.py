"""Upserts, syncs, sources, sinks and the pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import joins, ordering, upsert
from isobar.plans import etl, sync
from isobar.session import work_path, work_table
from isobar.sources import files, generate, tables
from tests.conftest import rows

D = dt.date
KEY = ["station_id", "observation_date"]
SMALL = "station_id string, observation_date date, year int, region string, temp_mean double, humidity double"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [
            ("a", D(2020, 1, 1), 2020, "E", 1.0, 10.0),
            ("a", D(2021, 1, 1), 2021, "E", 2.0, 20.0),
            ("b", D(2020, 1, 1), 2020, "S", 3.0, 30.0),
        ],
        SMALL,
    )


@pytest.fixture(scope="module")
def incoming(spark):
    return spark.createDataFrame(
        [
            ("a", D(2020, 1, 1), 2020, "E", None, 11.0),  # NULL overwrites
            ("a", D(2020, 1, 2), 2020, "E", 5.0, 50.0),
            ("a", D(2020, 1, 2), 2020, "E", 6.0, 60.0),  # same key
        ],
        SMALL,
    )


def merged(target, incoming):
    return upsert.upsert(target, incoming, KEY, ["temp_mean", "humidity"], [F.asc("temp_mean")])


def test_upsert(target, incoming):
    got = {(r.station_id, r.observation_date): (r.temp_mean, r.humidity, r.action) for r in merged(target, incoming).collect()}
    assert got == {
        ("a", D(2020, 1, 1)): (None, 11.0, "updated"),
        ("a", D(2020, 1, 2)): (5.0, 50.0, "created"),
        ("a", D(2021, 1, 1)): (2.0, 20.0, "kept"),
        ("b", D(2020, 1, 1)): (3.0, 30.0, "kept"),
    }


def test_upsert_twice_is_upsert_once(target, incoming):
    once = merged(target, incoming).drop("action")
    assert rows(merged(once, incoming).drop("action")) == rows(once)


def test_upsert_of_nothing(spark, target, incoming):
    none = target.where(F.lit(False))
    assert rows(merged(target, none).drop("action")) == rows(target)
    assert merged(none, incoming).count() == 2


def test_partial_rows_keep_other_columns(target, incoming):
    got = upsert.upsert(target, incoming.select(*KEY, "humidity"), KEY, ["humidity"], [F.asc("humidity")])
    by_key = {(r.station_id, r.observation_date): r for r in got.collect()}
    assert by_key["a", D(2020, 1, 1)].temp_mean == 1.0
    assert by_key["a", D(2020, 1, 1)].humidity == 11.0
    assert by_key["a", D(2020, 1, 2)].year is None


def test_insert_if_absent(target, incoming):
    got = upsert.insert_if_absent(target, incoming, KEY, [F.asc("temp_mean")]).collect()
    assert [(r.observation_date, r.temp_mean) for r in got] == [(D(2020, 1, 2), 5.0)]


def test_upsert_table_rewrites_touched_partitions_only(spark, target, incoming):
    name, path = work_table("t_obs"), work_path(spark, "t_obs")
    tables.write_warehouse(target, name, path=path, buckets=4)

    def files_of(part):
        return set(
            spark.table(name).where(part).select(F.col("_metadata.file_path")).distinct().toPandas()["file_path"]
        )

    before = files_of("year = 2021 OR region = 'S'")
    counts = upsert.upsert_table(
        spark, name, incoming, KEY, ["temp_mean", "humidity"], order=[F.asc("temp_mean")]
    ).first()
    assert (counts.created, counts.updated) == (1, 1)
    spark.catalog.refreshTable(name)
    assert files_of("year = 2021 OR region = 'S'") == before
    want = merged(target, incoming).drop("action")
    assert rows(spark.table(name).select(*want.columns)) == rows(want)


def test_load_log(spark, target, incoming):
    name = work_table("t_log")
    counts = upsert.action_counts(merged(target, incoming), "observations")
    for _ in range(2):
        upsert.log_load(spark, name, counts, "csv", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    log = spark.table(name)
    assert log.count() == 2 and log.first().created == 1
    assert log.columns == schemas.LOAD_LOG.names


def sync_frames(spark):
    """Empty tables to sync into, regions, and observations of three years."""
    names = sync.SyncTables(*(work_table(f"t_{k}") for k in ("regions", "stations", "observations", "log")))
    frame = spark.createDataFrame
    tables.load_table(frame([], schemas.REGIONS), names.regions)
    stations = "station_id string, station_name string, country string, region_code string, latitude double, longitude double, is_coastal boolean, is_active boolean, elevation double"
    tables.load_table(frame([], stations), names.stations)
    measures = ", ".join(f"{m} double" for m in schemas.MEASURES)
    columns = f"station_id string, observation_date date, year int, {measures}"
    tables.write_warehouse(frame([], columns), names.observations, ("year",), None, fmt="parquet")
    data = [
        (s, D(y, m, 1), y, *[float(k + y - 2000 + m)] * 5, 20.0 if (s, y) == ("a", 2020) else None, None, f"name {s}", f"land {s}", "East Africa", 1.0, 2.0)
        for k, s in enumerate("abc")
        for y in (2020, 2021, 2022)
        for m in (1, 6, 12)
    ]
    more = "station_name string, country string, region string, latitude double, longitude double"
    return names, sync.default_regions(spark), frame(data, f"{columns}, {more}")


def test_windows_in_any_order_are_one_sync(spark):
    order = [F.col("temp_mean")]
    whole, regions, source = sync_frames(spark)
    sync.publish_sync(spark, whole, regions, source, order)
    parts, _, _ = sync_frames(spark)
    windows = [(D(2021, 6, 1), D(2021, 12, 31)), (None, D(2021, 5, 31)), (D(2022, 1, 1), None)]
    for start, end in windows:
        sync.publish_sync(spark, parts, regions, source, order, start=start, end=end)
    for kind in ("stations", "observations", "regions"):
        got, want = spark.table(getattr(parts, kind)), spark.table(getattr(whole, kind))
        assert rows(got.select(*want.columns)) == rows(want)
    assert upsert.high_water(spark, parts.log, sync.SYNC) == D(2022, 12, 1)


def test_loads_since_the_newest_day(spark):
    """Late rows within the overlap come in, older ones do not; other partitions keep their files."""
    order = [F.col("temp_mean")]
    names, regions, source = sync_frames(spark)
    late = (F.col("station_id") == "c") & (F.col("year") < 2022)
    sync.publish_sync(spark, names, regions, source.where("year < 2022").where(~late), order, load_id="one")
    table = lambda: spark.table(names.observations)
    files = lambda y: {r[0] for r in table().where(f"year = {y}").select("_metadata.file_path").distinct().collect()}
    old, rewritten = files(2020), files(2021)
    counts = {r.entity: r for r in sync.sync_since(spark, names, regions, source, order, overlap_days=200, load_id="two").collect()}
    # Since 2021-05-15: two months of 2021, of which two stations were there, and 2022.
    assert (counts["observations"].created, counts["observations"].updated) == (2 + 9, 4)
    spark.catalog.refreshTable(names.observations)
    assert files(2020) == old and not files(2021) & rewritten
    assert table().where("station_id = 'c'").count() == 5
    again = sync.sync_since(spark, names, regions, source, order, load_id="two").collect()
    assert {(r.created, r.updated, r.skipped) for r in again} == {(0, 0, 0)}
    assert spark.table(names.log).where("load_id = 'two'").count() == 3
    few = sync.publish_sync(spark, names, regions, source, order, limit=4, tie=["station_id"])
    assert few.where("entity = 'observations'").first().updated == 4


def test_a_failed_load_changes_nothing_and_is_logged(spark):
    names, regions, source = sync_frames(spark)
    broken = source.withColumn("temp_max", F.when(F.col("year") == 2022, F.raise_error(F.lit("unreadable"))).otherwise(1.0))
    with pytest.raises(Exception, match="unreadable"):
        sync.publish_sync(spark, names, regions, broken, [F.col("temp_mean")], load_id="x")
    assert spark.table(names.stations).isEmpty() and spark.table(names.regions).isEmpty()
    log = spark.table(names.log).collect()
    assert [(r.status, r.load_id, r.newest) for r in log] == [("failed", "x", None)]
    # The same identifier may be tried again.
    sync.publish_sync(spark, names, regions, source, [F.col("temp_mean")], load_id="x")
    assert spark.table(names.observations).count() == 27


def test_flag_existing(target, incoming):
    got = joins.flag_existing(incoming, target, KEY)
    assert sorted(r.exists for r in got.collect()) == [False, False, True]


def test_sync_regions_from_nothing(spark):
    empty = spark.createDataFrame([], schemas.REGIONS)
    first = sync.sync_regions(empty, sync.default_regions(spark))
    assert {r.action for r in first.collect()} == {"created"} and first.count() == 5
    again = sync.sync_regions(first.drop("action"), sync.default_regions(spark))
    assert {r.action for r in again.collect()} == {"updated"} and again.count() == 5


def test_sync_observations_window_and_limit(spark):
    source = spark.createDataFrame(
        [("a", D(2020, 1, d), 2020, 1, *[float(d)] * 7) for d in range(1, 11)] + [("zz", D(2020, 1, 9), 2020, 1, *[0.0] * 7)],
        "station_id string, observation_date date, year int, month int, "
        + ", ".join(f"{m} double" for m in schemas.MEASURES),
    )
    stations = spark.createDataFrame([("a",)], "station_id string")
    none = source.where(F.lit(False))
    got = sync.sync_observations(source, none, stations, [F.asc("humidity")], D(2020, 1, 4), D(2020, 1, 9), limit=3, tie=["station_id"])
    assert {r.observation_date.day for r in got.merged.collect()} == {9, 8}
    counts = sync.observation_counts(got).first()
    assert (counts.created, counts.updated, counts.skipped) == (2, 0, 1)


def write_text(path, text):
    path.write_text(text)
    return str(path)


STATION_CSV = """station_id,station_name,country,region,latitude,longitude,elevation,is_coastal,is_active,extra
KE-EAS-00001,Station 1,KE,East,1.5,36.25,,true,false,x
ZA-SOU-00002,Station 2,ZA,South,-30.1,25.0,120.5,false,true,y
"""


def test_read_csv(spark, tmp_path):
    path = write_text(tmp_path / "stations.csv", STATION_CSV)
    got = files.read_csv(spark, path, schemas.STATIONS).orderBy("station_id").collect()
    assert got[0].elevation is None and got[0].is_coastal is True and got[0].is_active is False
    assert got[1].latitude == -30.1 and len(got[0]) == 9


def test_bad_lines_are_kept(spark, tmp_path):
    path = write_text(tmp_path / "c.csv", "date,region,temperature,rainfall,humidity\n2024-01-01,East,20.5,1,50\n2024-13-01,East,x,1,50\n")
    got = files.read_csv_checked(spark, path, schemas.CLIMATE_DATA).cache()
    assert got.where("_bad_line IS NULL").count() == 1
    assert got.where("_bad_line IS NOT NULL").first()._bad_line.startswith("2024-13-01")


def test_external_table(spark, tmp_path):
    folder = tmp_path / "ext"
    folder.mkdir()
    write_text(folder / "s.csv", STATION_CSV)
    name = work_table("ext_stations")
    assert files.external_table(spark, name, schemas.STATIONS, str(folder)).count() == 2
    spark.sql(f"DROP TABLE {name}")
    assert (folder / "s.csv").exists()


def test_load_station_text(spark, tmp_path):
    text = STATION_CSV + "KE-EAS-00003,,,Outer Isles,north,1,2,1,1,z\n"
    path = write_text(tmp_path / "stations.csv", text)
    target = spark.createDataFrame(
        [("ZA-SOU-00002", "Old", "ZA", "SOUTH", 0.0, 0.0, True, False, 1.0)],
        "station_id string, station_name string, country string, region_code string, latitude double, "
        "longitude double, is_coastal boolean, is_active boolean, elevation double",
    )
    regions = spark.createDataFrame([("South", "SOUTH", "")], schemas.REGIONS)
    done, rejects = sync.load_station_text(spark, path, target, regions)
    got = {r.station_id: r for r in done.stations.collect()}
    assert {k: r.action for k, r in got.items()} == {"KE-EAS-00001": "created", "ZA-SOU-00002": "updated"}
    # The file says which stations are active.
    assert got["KE-EAS-00001"].is_active is False and got["ZA-SOU-00002"].is_active is True
    assert [r.code for r in done.new_regions.collect()] == ["EAST"]
    assert [r.station_id for r in rejects.collect()] == ["KE-EAS-00003"]


def test_reads_need_a_partition_bound(spark, target):
    name = work_table("strict")
    tables.write_warehouse(target, name, path=work_path(spark, "strict"), buckets=None)
    assert tables.read_partitions(spark, name, year=2020).count() == 2
    assert tables.read_partitions(spark, name, year=(2020, 2021), region=["E", "N"]).count() == 2
    with pytest.raises(ValueError):
        tables.read_partitions(spark, name)
    with pytest.raises(ValueError):
        tables.read_partitions(spark, name, month=1)


OBS_CSV = """station_id,observation_date,year,month,temp_max,temp_min,temp_mean,precipitation,humidity,sea_surface_temp,ocean_salinity,region
a,2020-01-01,,,2,1,1.5,0,50,,,E
a,2020-01-01 00:00:00,2020,1,9,9,9,9,9,,,E
a,2020-01-02,2020,1,2,1,1.5,0,50,,,E
a,,2020,1,2,1,1.5,0,50,,,E
a,02/01/2020,2020,1,2,1,1.5,0,50,,,E
a,2020-01-03,2020,1,2,1,oops,0,50,,,E
q,2020-01-03,2020,1,2,1,1.5,0,50,,,E
"""


def test_load_observation_text(spark, tmp_path):
    path = write_text(tmp_path / "o.csv", OBS_CSV)
    stations = spark.createDataFrame([("a",)], "station_id string")
    there = spark.createDataFrame([("a", D(2020, 1, 2))], "station_id string, observation_date date")
    got = sync.load_observation_text(spark, path, stations, there, [F.asc("temp_max")])
    by_action = {}
    for r in got.collect():
        by_action.setdefault(r.action, []).append(r)
    assert {k: len(v) for k, v in by_action.items()} == {"created": 1, "duplicate": 1, "skipped": 2, "error": 2}
    new = by_action["created"][0]
    assert (new.observation_date, new.year, new.month, new.temp_mean) == (D(2020, 1, 1), 2020, 1, 1.5)
    assert {e for r in by_action["error"] for e in r.errors} == {
        "observation_date is not a date", "temp_mean is not a number",
    }


def test_load_limit(spark, tmp_path):
    path = write_text(tmp_path / "o.csv", OBS_CSV)
    stations = spark.createDataFrame([("a",)], "station_id string")
    there = spark.createDataFrame([], "station_id string, observation_date date")


def test_export_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "x string, y double")
    files.export(df, str(tmp_path / "csv"), "csv")
    files.export(df, str(tmp_path / "json"), "json")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["x", "y"]
    assert spark.read.json(str(tmp_path / "json")).columns == ["x", "y"]
    with pytest.raises(ValueError):
        files.export(df, str(tmp_path / "xml"), "xml")


def test_run_sql_is_lazy_and_reports_unknown_columns(spark, target):
    assert files.run_sql(spark, "SELECT count(*) AS n FROM {t}", t=target).first().n == 3
    with pytest.raises(Exception, match="nowhere"):
        files.run_sql(spark, "SELECT nowhere FROM {t}", t=target)


def test_warehouse_layout(spark, target):
    name = work_table("layout")
    tables.write_warehouse(target, name, path=work_path(spark, "layout"), buckets=32)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert info["Provider"].lower() == "orc" and info["Num Buckets"] == "32"
    assert info["Bucket Columns"] == "[`station_id`]" and "compression=snappy" in info["Storage Properties"]
    assert rows(spark.table(name).select(*target.columns)) == rows(target)


def test_dynamic_overwrite_keeps_other_partitions_and_the_setting(spark, target):
    name = work_table("dyn")
    tables.write_warehouse(target, name, path=work_path(spark, "dyn"), buckets=None)
    before = spark.conf.get(tables.OVERWRITE_MODE)
    new = target.where("year = 2021").withColumn("temp_mean", F.lit(9.0))
    tables.overwrite_partitions(new.select("*"), name)
    assert spark.conf.get(tables.OVERWRITE_MODE) == before
    got = {(r.station_id, r.year): r.temp_mean for r in spark.table(name).collect()}
    assert got == {("a", 2020): 1.0, ("a", 2021): 9.0, ("b", 2020): 3.0}


@pytest.mark.parametrize("count,groups,want", [(0, 1, 1), (10**6, 35, 1), (10**9, 35, 16), (10**12, 35, 16_384)])
def test_buckets_follow_the_size(count, groups, want):
    assert tables.buckets_for(count, groups) == want


def test_storage_report(spark):
    df = generate.gen_climate(generate.ids(spark, 5000))
    got = {r.format: r for r in tables.storage_report(df, work_path(spark, "storage")).collect()}
    assert set(got) == {"text", "text_gzip", "orc", "parquet"}
    assert got["text"].percent_of_text == 100.0
    assert all(got[f].bytes < got["text"].bytes for f in ("text_gzip", "orc", "parquet"))


def test_storage_report_works_the_frame_out_once(spark):
    worked_out = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            worked_out.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(run, "id long")
    assert tables.storage_report(df, work_path(spark, "storage")).count() == 4
    assert worked_out.value == 100


def test_buckets_of_windows_by_station_follow_the_whole_table(monkeypatch):
    from isobar.plans.adapter import Inputs
    from isobar.plans.catalog import loads

    class Seen(Exception):
        pass

    def buckets_for(*args):
        raise Seen(*args)

    class Few(Inputs):
        fact = type("Fact", (), {"count": lambda self: 10**9})()
        raw_obs = stations = baselines = None

    monkeypatch.setattr(loads.tables, "buckets_for", buckets_for)
    monkeypatch.setattr(loads.etl, "transform", lambda *a: None)
    with pytest.raises(Seen) as seen:
        loads._reloaded(Few(None, "/nowhere"))
    assert seen.value.args == (10**9,)


def test_merge_without_null_keys(spark, target):
    incoming = spark.createDataFrame([("a", D(2020, 1, 1), 2020, "E", None, 11.0), ("c", D(2020, 1, 1), 2020, "S", 4.0, 40.0)], SMALL)
    target = target.union(spark.createDataFrame([(None, None, 2020, "E", 9.0, 9.0)], SMALL))
    both = [upsert.merge_flagged(target, incoming, KEY, ["temp_mean", "humidity"], null_keys=k) for k in (True, False)]
    assert rows(both[0]) == rows(both[1])


def test_arrived_counts_in_one_pass(spark):
    stations = spark.createDataFrame([("a",), ("a",), (None,)], "station_id string")
    source = spark.createDataFrame(
        [("a", D(2020, 1, 1), 2020), ("a", D(2020, 1, 1), 2020), ("x", D(2020, 2, 1), 2020), ("a", None, None), (None, D(2021, 1, 1), 2021)],
        "station_id string, observation_date date, year int",
    )
    got = sorted(sync._arrived(source, stations, ["year"]), key=repr)
    assert [tuple(r) for r in got] == [(2020, 2, 1, D(2020, 2, 1)), (2021, 0, 1, D(2021, 1, 1)), (None, 0, 1, None)]


def test_table_stats(spark, target):
    name = work_table("stats")
    tables.load_table(target, name)
    got = {r.column_name: r for r in tables.table_stats(spark, name).collect()}
    assert got["temp_mean"].row_count == 3 and got["temp_mean"].max_value == 3.0
    assert got["region"].distinct_estimate == 2 and got["region"].min_value is None


def test_pipeline_parts_add_up(spark):
    stations = generate.gen_stations(generate.ids(spark, 20)).where("is_active")
    raw = generate.gen_obs(stations, 30).withColumn(
        "observation_date", F.when(F.col("month") != 12, F.col("observation_date"))
    )
    baselines = spark.createDataFrame([("East", 24.0)], schemas.BASELINES)
    monthly = etl.run(raw, stations, baselines, work_table("pipe"), work_path(spark, "pipe"), 2)
    assert monthly.agg(F.sum("observation_count")).first()[0] == raw.where("month <> 12").count()
    assert raw.where("month <> 12").count() > 0


def test_distribute_sort_keeps_rows_and_order(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("region"), (1000 - F.col("id")).alias("v"))
    out = ordering.distribute_sort(df, ["region"], ["v"]).withColumn("p", F.spark_partition_id())
    assert out.count() == 1000
    seen = {}
    for r in out.collect():
        assert seen.get(r.p, (-1, -1)) <= (r.region, r.v)
        seen[r.p] = (r.region, r.v)


# -- generators --------------------------------------------------------------


@pytest.fixture(scope="module")
def world(spark):
    st = generate.gen_stations(generate.ids(spark, 2000)).cache()
    return st, generate.gen_obs(st, 60).cache()


def test_generated_stations(world):
    st = world[0]
    assert st.select("station_id").distinct().count() == 2000
    for r in st.limit(200).collect():
        countries, lat, lon, _ = generate.REGION_PROFILES[r.region]
        assert r.country in countries.split() and r.station_id.startswith(f"{r.country}-{r.region[:3].upper()}-")
        assert lat[0] <= r.latitude <= lat[1] and lon[0] <= r.longitude <= lon[1]
    share = st.agg(F.avg(F.col("is_coastal").cast("int")), F.avg(F.col("is_active").cast("int"))).first()
    assert share[0] == pytest.approx(0.3, abs=0.04) and share[1] == pytest.approx(0.95, abs=0.02)


def test_generated_days_are_distinct(world):
    st, obs = world
    assert obs.count() == 2000 * 60
    assert obs.select("station_id", "observation_date").distinct().count() == 2000 * 60
    first, last = obs.agg(F.min("observation_date"), F.max("observation_date")).first()
    assert first >= D(1980, 1, 1) and last <= D(2024, 12, 31)


def test_generated_climate_has_the_published_statistics(world):
    obs = world[1]
    means = {r[0]: r[1] for r in obs.groupBy("region").agg(F.avg("temp_mean")).collect()}
    for region, (*_, base) in generate.REGION_PROFILES.items():
        assert means[region] == pytest.approx(base + 2.5, abs=0.25)
    spread = obs.groupBy("region").agg(
        F.stddev_pop(F.col("temp_max") - F.col("temp_min")), F.stddev_pop("temp_mean"),
        F.corr("humidity", "precipitation"), F.avg("precipitation"),
    )
    rain = {}
    for region, daily, mean, corr, wet in spread.collect():
        assert daily == pytest.approx(2.449, abs=0.05) and mean == pytest.approx(7.217, abs=0.12)
        assert abs(corr) < 0.03
        rain[region] = wet
    dry = (rain["North"] + rain["South"] + rain["West"]) / 3
    assert rain["Central"] / dry == pytest.approx(10 / 3, rel=0.08)


def test_generated_coast(world):
    st, obs = world
    both = obs.join(st.select("station_id", "is_coastal"), "station_id")
    assert both.where(F.col("is_coastal") != F.col("sea_surface_temp").isNotNull()).count() == 0
    low, high = obs.agg(F.min("ocean_salinity"), F.max("ocean_salinity")).first()
    assert low >= 33 and high <= 37


def test_generation_does_not_depend_on_partitions(spark):
    a = generate.gen_obs(generate.gen_stations(generate.ids(spark, 30)), 5)
    b = generate.gen_obs(generate.gen_stations(generate.ids(spark, 30).repartition(7)), 5)
    assert rows(a) == rows(b)
    assert rows(a) != rows(generate.gen_obs(generate.gen_stations(generate.ids(spark, 30)), 5, seed=9))


def test_too_many_days(spark):
    with pytest.raises(ValueError):
        generate.gen_obs(generate.gen_stations(generate.ids(spark, 1)), 20_000)


def test_generated_ocean_and_climate(spark):
    ocean = generate.gen_ocean(generate.ids(spark, 3000))
    assert ocean.columns == schemas.OCEAN_DATA.names
    low, high = ocean.agg(F.min("ph_level"), F.max("ph_level")).first()
    assert 7.8 <= low < 7.82 and 8.38 < high <= 8.4
    assert generate.gen_climate(generate.ids(spark, 10)).columns == schemas.CLIMATE_DATA.names
