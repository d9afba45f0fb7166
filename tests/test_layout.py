"""Two-level tables, statistics per partition, histograms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isobar.operators import joins
from isobar.session import work_table
from isobar.sources import layout, tables
from tests.conftest import plan, rows

COLUMNS = "station_id long, observation_date date, temp_mean double, year int, region string"


def readings(spark, n, station):
    """n rows; `station` gives the station of the k-th."""
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int"))
    return spark.range(n).select(
        station(F.col("id")).alias("station_id"), day.alias("observation_date"), (F.col("id") % 40).cast("double").alias("temp_mean"),
        F.year(day).alias("year"), F.when(F.col("id") % 5 != 0, "E's").alias("region"),
    )


def per_file(df):
    return [r["count"] for r in df.groupBy("_metadata.file_path").count().collect()]


def test_one_station_is_spread_over_bounded_files(spark):
    df = readings(spark, 40_000, lambda k: F.lit(7).cast("long"))
    l = layout.Layout(work_table("t_one"), buckets=4, max_rows=2000)  # noqa: E741
    got = layout.publish(df, l)
    assert rows(got.groupBy("year", "region").count()) == rows(df.groupBy("year", "region").count())
    assert spark.table(l.cold).isEmpty()
    counts = per_file(spark.table(l.hot))
    assert sum(counts) == 40_000 and max(counts) <= l.max_rows
    # A task that reads files whole holds no more than a file.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        sizes = spark.table(l.hot).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sizes <= l.max_rows


@pytest.fixture
def mixed(spark):
    """Half of the rows on station 0."""
    return readings(spark, 6000, lambda k: F.when(k % 2 == 0, F.lit(0)).otherwise(k % 97).cast("long"))


def test_reload_moves_and_drops(spark, mixed):
    l = layout.Layout(work_table("t_two"), buckets=4, max_rows=300)  # noqa: E741
    layout.publish(mixed, l)
    order = ["station_id", "observation_date", "temp_mean", "year", "region"]
    assert {r[0] for r in spark.table(l.hot).select("station_id").distinct().collect()} == {0}
    assert rows(spark.table(l.name).select(*order)) == rows(mixed.select(*order))
    year = F.col("year") == 2021
    # 2021 without ordinary stations; station 0 has few rows there now, but stays where it is.
    again = mixed.where(year & (F.col("station_id") == 0) & (F.col("temp_mean") < 4))
    layout.reload(again, l)
    now = mixed.where(~year).unionByName(again)
    # Partitions that the frame lacks stay.
    lacking = mixed.where(year).select("region").distinct().exceptAll(again.select("region").distinct())
    assert lacking.isEmpty()
    assert rows(spark.table(l.name).select(*order)) == rows(now.select(*order))
    assert spark.table(l.cold).where(year).isEmpty()
    # Another station becomes hot with a load.
    more = readings(spark, 2000, lambda k: F.lit(5).cast("long")).where("year = 2021")
    layout.reload(more, l)
    now = mixed.where(~year).unionByName(more)
    assert rows(spark.table(l.name).select(*order)) == rows(now.select(*order))
    assert {r[0] for r in spark.table(l.hot).where(year).select("station_id").distinct().collect()} == {5}


def test_bucketed_part_joins_without_exchange(spark, mixed):
    l = layout.Layout(work_table("t_join"), parts=(), buckets=4, max_rows=1000)  # noqa: E741
    layout.publish(mixed, l)
    stations = spark.range(100).select(
        F.col("id").alias("station_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("country"), F.lit("r").alias("region")
    )
    dim = tables.write_warehouse(stations, work_table("t_dim"), (), 4, "station_id")
    want = rows(joins.country_region_shuffle(mixed, stations))
    assert rows(joins.country_region_bucketed(spark.table(l.cold), dim, spark.table(l.hot))) == want
    text = plan(joins.country_region_bucketed(spark.table(l.cold), dim))
    assert text.count("Exchange hashpartitioning(station_id") == 0


def test_statistics_of_partitions(spark, mixed):
    name = work_table("t_parts")
    tables.write_warehouse(mixed, name, buckets=None)
    got = tables.partition_stats(spark, name)
    assert got.agg(F.sum("row_count")).first()[0] == 6000 and got.count() == 4
    assert got.where("row_count <= 0 OR bytes <= 0").isEmpty()


def test_histogram_serves_the_optimizer(spark):
    """Nine tenths of the readings are 1: without a histogram a range is guessed as its share of the span."""
    name = work_table("t_hist")
    df = spark.range(20_000).select(F.when(F.col("id") % 10 != 0, 1.0).otherwise((F.col("id") % 1000).cast("double")).alias("v"))
    tables.load_table(df, name)

    def guessed():
        text = spark.table(name).where("v > 500")._jdf.queryExecution().optimizedPlan().stats().rowCount()
        return int(str(text.get()))

    real = df.where("v > 500").count()
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS v")
    plain = guessed()
    bins = tables.histogram(spark, name, "v")
    assert bins.count() > 100
    assert bins.where("low > high").isEmpty()
    spark.catalog.refreshTable(name)
    assert abs(guessed() - real) < abs(plain - real) / 5
