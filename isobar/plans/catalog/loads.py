"""Pipeline stages, upserts and syncs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from isobar.functions.columns import stable_round
from isobar.operators import upsert
from isobar.operators.clean import clean
from isobar.plans import etl, summaries, sync
from isobar.plans.adapter import TIE, r, with_views
from isobar.plans.catalog.base import query, rounded
from isobar.plans.catalog.scans import station_text
from isobar.schemas import MEASURES
from isobar.session import work_path, work_table
from isobar.sources import layout as two_level
from isobar.sources import tables

TIE_SQL = "k1, k2, k3"
KEY_SQL = f"{TIE_SQL}, station_id"
FIRST_SQL = "QUALIFY row_number() OVER (PARTITION BY station_id, observation_date ORDER BY k1, k2, k3) = 1"

# -- pipeline ----------------------------------------------------------------


@query(
    "etl_extract",
    with_views("raw", f"SELECT {KEY_SQL}, observation_date, temp_mean FROM raw WHERE observation_date IS NOT NULL"),
)
def etl_extract(t):
    return etl.extract(t.raw).select("k1", "k2", "k3", "station_id", "observation_date", "temp_mean")


# The pipeline's raw input carries the region, as the delivered files do.
RAW_REGION = "raw_r AS (SELECT raw.*, s.region FROM raw JOIN stations s USING (station_id) WHERE observation_date IS NOT NULL)"
CLEANED = f"""cleaned AS (
    SELECT * REPLACE (
      CASE WHEN temp_mean BETWEEN -50 AND 60 THEN temp_mean END AS temp_mean,
      CASE WHEN humidity < 0 THEN 0 WHEN humidity > 100 THEN 100 ELSE humidity END AS humidity,
      coalesce(precipitation, avg(precipitation) OVER (PARTITION BY region)) AS precipitation)
    FROM raw_r)"""
ENRICHED = """enriched AS (
    SELECT c.*, s.station_name, s.country, s.latitude, s.longitude, b.baseline_temp,
           c.temp_mean - b.baseline_temp AS temp_anomaly
    FROM cleaned c JOIN stations s ON c.station_id = s.station_id LEFT JOIN baselines b ON s.region = b.region)"""
PIPELINE = "WITH " + ", ".join([RAW_REGION, CLEANED, ENRICHED])


@query(
    "etl_clean",
    with_views(
        "stations raw",
        f"WITH {RAW_REGION}, {CLEANED} SELECT {KEY_SQL}, region, temp_mean, humidity, {r('precipitation', 6)} AS precipitation FROM cleaned",
    ),
)
def etl_clean(t):
    rows = clean(etl.extract(t.raw_obs))
    rows = rows.select("k1", "k2", "k3", "station_id", "region", "temp_mean", "humidity", "precipitation")
    return rounded(rows, 6, "precipitation")


@query(
    "etl_enrich",
    with_views(
        "stations raw baselines",
        f"""{PIPELINE}
  SELECT {KEY_SQL}, region, country, latitude, longitude, temp_mean, temp_anomaly, humidity, {r('precipitation', 6)} AS precipitation,
         {r('sin(2 * pi() * month / 12)', 9)} AS month_sin, {r('cos(2 * pi() * month / 12)', 9)} AS month_cos
  FROM enriched""",
    ),
)
def etl_enrich(t):
    rows = etl.transform(t.raw_obs, t.stations, t.baselines).select(
        "k1", "k2", "k3", "station_id", "region", "country", "latitude", "longitude", "temp_mean",
        "temp_anomaly", "humidity", "precipitation", "month_sin", "month_cos",
    )
    return rounded(rounded(rows, 6, "precipitation"), 9, "month_sin", "month_cos")


MONTHLY_SQL = (
    f"region, year, month, {r('avg(temp_mean)', 6)} AS avg_temp, "
    f"{r('sum(precipitation)', 2)} AS total_precip, count(*) AS observation_count"
)


@query(
    "etl_aggregate",
    with_views(
        "stations raw baselines",
        f"""{PIPELINE}, m AS (SELECT region, year, month, avg(temp_mean) AS a, {MONTHLY_SQL.split('month, ', 1)[1]} FROM enriched GROUP BY region, year, month)
  SELECT m.region, m.year, m.month, m.avg_temp, m.total_precip, m.observation_count, {r('m.a - p.a', 2)} AS change
  FROM m LEFT JOIN m p ON m.region = p.region AND m.month = p.month AND p.year = m.year - 1""",
    ),
)
def etl_aggregate(t):
    """The monthly summary with its change against the year before."""
    parts = etl.aggregate(etl.transform(t.raw_obs, t.stations, t.baselines))
    monthly = rounded(rounded(parts.monthly, 6, "avg_temp"), 2, "total_precip")
    change = parts.yearly_change.select("region", "year", "month", "change")
    return monthly.join(change, ["region", "year", "month"])


LOADED = ["k1", "k2", "k3", "station_id", "year", "month", "region", "temp_mean", "temp_anomaly", "country"]


@query(
    "etl_load",
    with_views(
        "stations raw baselines",
        f"""{PIPELINE}
  SELECT {KEY_SQL}, year, month, region, CASE WHEN year = 1997 THEN temp_mean + 100 ELSE temp_mean END AS temp_mean,
         temp_anomaly, country
  FROM enriched""",
    ),
)
def etl_load(t):
    """Published, then one year published again with other readings; read back whole."""
    rows = etl.transform(t.raw_obs, t.stations, t.baselines)
    name = work_table("isobar_published")
    table = etl.load(rows, name, work_path(t.spark, "published"), buckets=2, keep=TIE)
    again = table.where("year = 1997").withColumn("temp_mean", F.col("temp_mean") + 100)
    # A table cannot be overwritten while it is read: stage the new rows.
    stage = work_path(t.spark, "again")
    again.write.parquet(stage)
    etl.reload(t.spark.read.schema(again.schema).parquet(stage), name)
    return t.spark.table(name).select(*LOADED)


@query(
    "etl_layout",
    with_views(
        "stations raw baselines",
        f"""{PIPELINE}
  SELECT {KEY_SQL}, year, month, region, CASE WHEN year = 1997 AND station_id % 2 = 0 THEN temp_mean + 100 ELSE temp_mean END AS temp_mean,
         temp_anomaly, country
  FROM enriched WHERE year <> 1997 OR station_id % 2 = 0
     OR region NOT IN (SELECT region FROM enriched WHERE year = 1997 AND station_id % 2 = 0)""",
    ),
)
def etl_layout(t):
    """Published in two levels, hot stations apart; one year again with half of its stations; read whole.

    Regions of the year without any of those stations are not in the load, and stay.
    """
    rows = etl.transform(t.raw_obs, t.stations, t.baselines).select(*TIE, *etl.PUBLISHED)
    count = t.fact.count()
    # A station is hot here with twice the mean rows of a station and year.
    bound = 2 * count // max(1, 7 * t.table("supplier").count()) + 1
    layout = two_level.Layout(work_table("isobar_layout"), buckets=tables.buckets_for(count, 35), max_rows=bound)
    table = two_level.publish(rows, layout, work_path(t.spark, "layout"))
    again = table.where("year = 1997 AND station_id % 2 = 0").withColumn("temp_mean", F.col("temp_mean") + 100)
    # A table cannot be overwritten while it is read.
    two_level.reload(_staged_rows(again, "again"), layout)
    return t.spark.table(layout.name).select(*LOADED)


@query(
    "etl_full",
    with_views("stations raw baselines", f"{PIPELINE} SELECT {MONTHLY_SQL} FROM enriched GROUP BY region, year, month"),
)
def etl_full(t):
    """Extract, clean, enrich, load, and summarize the published table."""
    # Some 35 (year, region) pairs share the rows; the files know how many there are.
    buckets = tables.buckets_for(t.fact.count(), 35)
    out = etl.run(
        t.raw_obs, t.stations, t.baselines, work_table("isobar_etl"), work_path(t.spark, "etl"), buckets
    )
    return rounded(rounded(out, 6, "avg_temp"), 2, "total_precip")


@query(
    "append_summary",
    with_views(
        "obs",
        f"SELECT {MONTHLY_SQL} FROM obs GROUP BY region, year, month "
        f"UNION ALL SELECT {MONTHLY_SQL} FROM obs WHERE year >= 2000 GROUP BY region, year, month",
    ),
)
def append_summary(t):
    """The summary table after a full and a partial append."""
    name = work_table("isobar_summary")
    empty = etl.monthly_climate(t.obs).where(F.lit(False))
    tables.load_table(empty, name, path=work_path(t.spark, "summary"))
    etl.append_summary(t.obs, name)
    etl.append_summary(t.obs.where("year >= 2000"), name)
    return rounded(rounded(t.spark.table(name), 6, "avg_temp"), 2, "total_precip")


# -- outputs kept up to date -------------------------------------------------
# As above, but one year is published again with other readings.

RELOAD = 1997
AGAIN = f"""again AS (
    SELECT * REPLACE (CASE WHEN year = {RELOAD} THEN temp_mean + 100 ELSE temp_mean END AS temp_mean,
                      CASE WHEN year = {RELOAD} THEN precipitation * 2 ELSE precipitation END AS precipitation)
    FROM enriched)"""
ROLLING_SQL = f"""SELECT station_id, observation_date,
         {r('sum(day) OVER (PARTITION BY station_id ORDER BY observation_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)', 2)} AS rolling_precip
  FROM (SELECT station_id, observation_date, sum(CAST(precipitation AS DECIMAL(18,5))) AS day FROM again GROUP BY station_id, observation_date)"""
CHANGE_SQL = f"""SELECT m.region, m.year, m.month, {r('m.a', 2)} AS avg_temp, {r('m.a - p.a', 2)} AS change
  FROM (SELECT region, year, month, avg(temp_mean) AS a FROM again GROUP BY region, year, month) m
  LEFT JOIN (SELECT region, year, month, avg(temp_mean) AS a FROM again GROUP BY region, year, month) p
  ON m.region = p.region AND m.month = p.month AND p.year = m.year - 1"""


def _reloaded(t):
    """All outputs published, then one year of the observations again."""
    rows = etl.transform(t.raw_obs, t.stations, t.baselines)
    name = work_table("isobar_outputs")
    names = summaries.Outputs(name, summaries.Summary(f"{name}_summary"), f"{name}_rolling", f"{name}_change")
    # Windows by station read a bucket of all partitions in one task.
    buckets = tables.buckets_for(t.fact.count())
    table = etl.load(rows, name, work_path(t.spark, "published"), buckets, keep=TIE)
    summaries.publish_outputs(t.spark, names)
    again = table.where(F.col("year") == RELOAD).withColumns(
        {"temp_mean": F.col("temp_mean") + 100, "precipitation": F.col("precipitation") * 2}
    )
    summaries.reload_year(t.spark, names, again, RELOAD)
    return names


@query("etl_rolling", with_views("stations raw baselines", f"{PIPELINE}, {AGAIN} {ROLLING_SQL}"))
def etl_rolling(t):
    """The published 30-day rain after a year was loaded again: the windows reach into it from the next."""
    return t.spark.table(_reloaded(t).rolling).select("station_id", "observation_date", "rolling_precip")


@query(
    "etl_outputs",
    with_views(
        "stations raw baselines",
        f"""{PIPELINE}, {AGAIN}, rolled AS ({ROLLING_SQL}), changed AS ({CHANGE_SQL})
  SELECT 'monthly' AS output, region, CAST(NULL AS BIGINT) AS station_id, year, month,
         {r('avg(temp_mean)', 6)} AS value, {r('sum(precipitation)', 2)} AS total, count(*) AS n
  FROM again GROUP BY region, year, month
  UNION ALL SELECT 'change', region, NULL, year, month, change, avg_temp, 1 FROM changed
  UNION ALL SELECT 'rolling', NULL, station_id, CAST(year(observation_date) AS INT), CAST(month(observation_date) AS INT),
         max(rolling_precip), {r('sum(rolling_precip)', 2)}, count(*)
  FROM rolled GROUP BY station_id, year(observation_date), month(observation_date)""",
    ),
)
def etl_outputs(t):
    """All three outputs of the pipeline after a year was loaded again, rolling rain summed up by month."""
    names = _reloaded(t)
    monthly = rounded(rounded(summaries.monthly(t.spark, names.summary), 6, "avg_temp"), 2, "total_precip")
    none = F.lit(None)
    rolled = t.spark.table(names.rolling).groupBy("station_id", "year", "month").agg(
        F.max("rolling_precip").alias("value"), stable_round(F.sum("rolling_precip"), 2).alias("total"), F.count("*").alias("n")
    )
    place = ["year", "month"]
    parts = [
        monthly.select(
            F.lit("monthly").alias("output"), "region", none.cast("long").alias("station_id"), *place,
            F.col("avg_temp").alias("value"), F.col("total_precip").alias("total"), F.col("observation_count").alias("n"),
        ),
        t.spark.table(names.change).select(
            F.lit("change").alias("output"), "region", none.cast("long").alias("station_id"), *place,
            F.col("change").alias("value"), F.col("avg_temp").alias("total"), F.lit(1).cast("long").alias("n"),
        ),
        rolled.select(F.lit("rolling").alias("output"), none.cast("string").alias("region"), "station_id", *place, "value", "total", "n"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "summary_refresh",
    with_views(
        "stations fact",
        f"""WITH base AS (SELECT * FROM fact WHERE k2 <= 4 {FIRST_SQL}),
       arriving AS (SELECT * FROM fact WHERE k2 >= 3 {FIRST_SQL}),
       merged AS (SELECT station_id, observation_date, year, month, temp_mean, precipitation FROM arriving
                  UNION ALL SELECT station_id, observation_date, year, month, temp_mean, precipitation FROM base b
                  WHERE NOT EXISTS (SELECT 1 FROM arriving a WHERE a.station_id = b.station_id AND a.observation_date = b.observation_date)),
       last AS (SELECT * REPLACE (CASE WHEN year = {RELOAD} THEN temp_mean - 7 ELSE temp_mean END AS temp_mean) FROM merged
                WHERE year <> {RELOAD} OR month <> 5)
  SELECT region, year, month, {r('avg(temp_mean)', 6)} AS avg_temp, {r('sum(precipitation)', 2)} AS total_precip,
         min(temp_mean) AS min_temp, max(temp_mean) AS max_temp, count(*) AS observation_count
  FROM last JOIN stations USING (station_id) GROUP BY region, year, month""",
    ),
)
def summary_refresh(t):
    """The summary after new keys came, known keys changed, and a year lost a month and was cooled."""
    held = ["station_id", "observation_date", "year", "month", "temp_mean", "precipitation"]
    place = t.stations.select("station_id", "region")
    key = sync.OBSERVATION_KEY
    base = _staged_rows(_target(t).select(*held).join(place, "station_id"), "base")
    coming = upsert.first_per_key(t.fact.where("k2 >= 3"), key, _order()).select(*held).join(place, "station_id")
    coming = _staged_rows(coming, "coming")
    s = summaries.Summary(work_table("isobar_state"))
    summaries.create(base, s, work_path(t.spark, "state"))

    fresh = coming.join(base, key, "left_anti")
    rows = base.unionByName(fresh)
    summaries.change(t.spark, s, rows, added=fresh)

    known = coming.join(base, key, "left_semi")
    replaced = base.join(coming, key, "left_semi")
    merged = _staged_rows(base.join(coming, key, "left_anti").unionByName(coming), "merged")
    summaries.change(t.spark, s, merged, added=known, removed=replaced)

    year = F.col("year") == RELOAD
    cooled = merged.where(year & (F.col("month") != 5)).withColumn("temp_mean", F.col("temp_mean") - 7)
    summaries.change(t.spark, s, merged.where(~year).unionByName(cooled), added=cooled, removed=merged.where(year))
    return rounded(rounded(summaries.monthly(t.spark, s), 6, "avg_temp"), 2, "total_precip")


def _staged_rows(df, name):
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- upserts -----------------------------------------------------------------
# Rows with k2 <= 4 are there already, rows with k2 >= 3 arrive; the first of a
# key under (k1, k2, k3) stands. Together they are all rows.

SIDES = (
    f"target AS (SELECT * FROM fact WHERE k2 <= 4 {FIRST_SQL}), "
    f"incoming AS (SELECT * FROM fact WHERE k2 >= 3 AND station_id IN (SELECT station_id FROM stations WHERE is_active) {FIRST_SQL})"
)
MERGED = ["station_id", "observation_date", "year", "month", *MEASURES]


def _order():
    return [F.col(c) for c in TIE]


def _target(t):
    rows = upsert.first_per_key(t.fact.where("k2 <= 4"), sync.OBSERVATION_KEY, _order())
    return rows.select(*MERGED)


def _merge_select() -> str:
    cols = ["coalesce(i.station_id, t.station_id) AS station_id",
            "coalesce(i.observation_date, t.observation_date) AS observation_date",
            "coalesce(t.year, i.year) AS year", "coalesce(t.month, i.month) AS month"]
    cols += [f"CASE WHEN i.station_id IS NOT NULL THEN i.{m} ELSE t.{m} END AS {m}" for m in MEASURES]
    return ", ".join(cols)


ACTION_SQL = (
    "CASE WHEN t.station_id IS NOT NULL AND i.station_id IS NOT NULL THEN 'updated' "
    "WHEN i.station_id IS NOT NULL THEN 'created' ELSE 'kept' END AS action"
)
FULL_JOIN = (
    "FROM target t FULL JOIN incoming i ON t.station_id = i.station_id AND t.observation_date = i.observation_date"
)


@query(
    "upsert_obs",
    with_views("stations fact", f"WITH {SIDES} SELECT {_merge_select()}, {ACTION_SQL} {FULL_JOIN}"),
)
def upsert_obs(t):
    """Arriving observations of active stations merged by (station, date)."""
    done = sync.sync_observations(
        t.fact.where("k2 >= 3"), _target(t), t.stations.where("is_active"), _order()
    )
    return done.merged


@query(
    "insert_if_absent",
    with_views(
        "stations fact",
        f"""WITH {SIDES}
  SELECT station_id, observation_date, k1, k2, k3, temp_mean FROM (SELECT * FROM fact WHERE k2 >= 3 {FIRST_SQL}) i
  WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.station_id = i.station_id AND t.observation_date = i.observation_date)""",
    ),
)
def insert_if_absent(t):
    new = upsert.insert_if_absent(
        _target(t), t.fact.where("k2 >= 3"), sync.OBSERVATION_KEY, _order()
    )
    return new.select("station_id", "observation_date", *TIE, "temp_mean")


SYNC_STATS_SQL = f"""
  SELECT 'observations' AS entity,
         (SELECT count(*) FROM merged WHERE action = 'created') AS created,
         (SELECT count(*) FROM merged WHERE action = 'updated') AS updated,
         (SELECT count(*) FROM fact WHERE k2 >= 3 AND station_id NOT IN (SELECT station_id FROM stations WHERE is_active)) AS skipped,
         CAST(0 AS BIGINT) AS errors"""


@query(
    "sync_stats",
    with_views("stations fact", f"WITH {SIDES}, merged AS (SELECT {ACTION_SQL} {FULL_JOIN}) {SYNC_STATS_SQL}"),
)
def sync_stats(t):
    done = sync.sync_observations(
        t.fact.where("k2 >= 3"), _target(t), t.stations.where("is_active"), _order()
    )
    return sync.observation_counts(done)


# Regions that are there, and arriving ones: the same with new texts, and the nations.
REGION_SIDES = (
    "target AS (SELECT * FROM regions), "
    "incoming AS (SELECT name, code, 'Updated ' || name AS description FROM regions UNION ALL "
    "SELECT n_name, upper(substr(n_name, 1, 10)), 'Nation ' || n_name FROM nation)"
)


def _region_sides(t):
    old = t.regions.select(
        "name", "code", F.concat(F.lit("Updated "), "name").alias("description")
    )
    new = t.table("nation").select(
        F.col("n_name").alias("name"),
        F.upper(F.substring("n_name", 1, 10)).alias("code"),
        F.concat(F.lit("Nation "), "n_name").alias("description"),
    )
    return t.regions, old.unionByName(new)


@query(
    "upsert_regions",
    with_views(
        "regions",
        f"""WITH {REGION_SIDES}
  SELECT coalesce(i.code, t.code) AS code, coalesce(i.name, t.name) AS name, coalesce(i.description, t.description) AS description,
         CASE WHEN t.code IS NOT NULL AND i.code IS NOT NULL THEN 'updated' WHEN i.code IS NOT NULL THEN 'created' ELSE 'kept' END AS action
  FROM target t FULL JOIN incoming i ON t.code = i.code""",
    ),
)
def upsert_regions(t):
    return sync.sync_regions(*_region_sides(t))


def _station_target(t):
    return t.stations.where("NOT is_active").select(
        "station_id", "station_name", "country", F.lit("OLD").alias("region_code"), "latitude",
        "longitude", F.lit(False).alias("is_coastal"), "is_active", "elevation",
    )


STATION_UPSERT_SQL = """
  SELECT s.station_id, s.station_name, s.country, replace(substr(upper(s.region), 1, 10), ' ', '_') AS region_code,
         s.latitude, s.longitude, f.sst IS NOT NULL AS is_coastal, s.is_active,
         CASE WHEN NOT s.is_active THEN s.elevation END AS elevation,
         CASE WHEN s.is_active THEN 'created' ELSE 'updated' END AS action
  FROM stations s JOIN (SELECT station_id, max(sea_surface_temp) AS sst FROM fact GROUP BY station_id) f ON s.station_id = f.station_id"""


@query("upsert_stations", with_views("stations fact", STATION_UPSERT_SQL))
def upsert_stations(t):
    """Stations found in the observations merged into the inactive ones; new ones are active."""
    return sync.sync_stations(t.obs, _station_target(t), t.regions).stations


@query(
    "load_station_csv",
    with_views(
        "stations",
        """WITH arriving AS (
    SELECT station_id, CASE WHEN station_id % 5 = 0 THEN CAST(station_id AS VARCHAR) ELSE station_name END AS station_name,
           CASE WHEN station_id % 7 <> 0 THEN country ELSE 'Unknown' END AS country,
           replace(substr(upper(region), 1, 10), ' ', '_') AS region_code,
           CASE WHEN station_id % 4 = 0 THEN 0 ELSE CAST(12.5 AS DOUBLE) END AS latitude,
           CASE WHEN station_id % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(-7 AS DOUBLE) END AS longitude,
           station_id % 5 IN (0, 1, 2) AS is_coastal, station_id % 3 <> 0 AS is_active,
           CASE WHEN station_id % 2 = 0 THEN CAST(250.5 AS DOUBLE) END AS elevation
    FROM stations WHERE station_id % 11 <> 0),
  target AS (SELECT station_id, station_name, country, 'OLD' AS region_code, latitude, longitude, false AS is_coastal, is_active, elevation
             FROM stations WHERE NOT is_active)
  SELECT a.*, CASE WHEN t.station_id IS NULL THEN 'created' ELSE 'updated' END AS action
  FROM arriving a LEFT JOIN target t ON a.station_id = t.station_id
  UNION ALL
  SELECT t.*, 'kept' FROM target t WHERE station_id NOT IN (SELECT station_id FROM arriving)""",
    ),
)
def load_station_csv(t):
    """A station file with gaps and bad numbers, merged into the inactive stations."""
    path = work_path(t.spark, "csv")
    station_text(t).write.option("header", True).csv(path)
    target = _station_target(t).withColumn("station_id", F.col("station_id").cast("string"))
    done, _ = sync.load_station_text(t.spark, path, target, t.regions)
    return done.stations.withColumn("station_id", F.col("station_id").cast("long"))


@query(
    "new_regions",
    with_views(
        "stations regions",
        "SELECT DISTINCT replace(substr(upper(region), 1, 10), ' ', '_') AS code, region AS name "
        "FROM stations",
    ),
)
def new_regions(t):
    """Regions a station sync must create: their texts match no known region."""
    known = t.regions.select(
        F.concat(F.lit("Old "), "name").alias("name"), F.concat(F.lit("OLD_"), "code").alias("code"), "description"
    )
    return sync.sync_stations(t.obs, _station_target(t), known).new_regions.drop("description")


@query(
    "full_sync",
    with_views(
        "stations fact regions",
        f"""WITH {SIDES.replace("station_id IN (SELECT station_id FROM stations WHERE is_active)", "true")},
       merged AS (SELECT {ACTION_SQL} {FULL_JOIN})
  SELECT 'regions' AS entity, (SELECT count(*) FROM nation) AS created, (SELECT count(*) FROM regions) AS updated,
         CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS errors
  UNION ALL SELECT 'stations', (SELECT count(*) FROM stations WHERE is_active AND station_id IN (SELECT station_id FROM fact WHERE k2 >= 3)),
         (SELECT count(*) FROM stations WHERE NOT is_active AND station_id IN (SELECT station_id FROM fact WHERE k2 >= 3)), 0, 0
  UNION ALL SELECT 'observations', (SELECT count(*) FROM merged WHERE action = 'created'),
         (SELECT count(*) FROM merged WHERE action = 'updated'), 0, 0""",
    ),
)
def full_sync(t):
    """Counts per entity when regions, stations and observations are synced into their tables."""
    names, regions = _sync_tables(t)
    return sync.publish_sync(t.spark, names, regions, t.obs.where("k2 >= 3"), _order())


def _sync_tables(t):
    """Published tables as they are before a sync, and the regions that arrive."""
    names = sync.SyncTables(*(work_table(f"isobar_sync_{k}") for k in ("regions", "stations", "observations", "log")))
    old, regions = _region_sides(t)
    tables.load_table(old, names.regions, path=work_path(t.spark, "sync-regions"))
    tables.load_table(_station_target(t), names.stations, path=work_path(t.spark, "sync-stations"))
    tables.write_warehouse(
        _target(t), names.observations, ("year",), None, path=work_path(t.spark, "sync-observations"), fmt="parquet"
    )
    return names, regions


def _synced_twice(t):
    names, regions = _sync_tables(t)
    for _ in range(2):
        sync.publish_sync(t.spark, names, regions, t.obs.where("k2 >= 3"), _order())
    return names


ALL_SIDES = SIDES.replace("station_id IN (SELECT station_id FROM stations WHERE is_active)", "true")


@query(
    "sync_rows",
    with_views("stations fact", f"WITH {ALL_SIDES} SELECT {_merge_select()} {FULL_JOIN}"),
)
def sync_rows(t):
    """The observation table after the same sync ran twice: the second one changes nothing."""
    return t.spark.table(_synced_twice(t).observations).select(*MERGED)


@query(
    "load_log",
    with_views(
        "stations fact regions",
        f"""WITH {ALL_SIDES}, merged AS (SELECT {ACTION_SQL} {FULL_JOIN}),
       n AS (SELECT (SELECT count(*) FROM nation) AS nations, (SELECT count(*) FROM regions) AS regions,
                    (SELECT count(*) FROM incoming) AS arrived, (SELECT count(*) FROM merged WHERE action = 'created') AS fresh,
                    (SELECT count(*) FROM stations WHERE station_id IN (SELECT station_id FROM fact WHERE k2 >= 3)) AS seen,
                    (SELECT count(*) FROM stations WHERE is_active AND station_id IN (SELECT station_id FROM fact WHERE k2 >= 3)) AS added)
  SELECT 'regions' AS entity, 'completed' AS status, CAST(2 AS BIGINT) AS runs, nations AS created, 2 * regions + nations AS updated FROM n
  UNION ALL SELECT 'stations', 'completed', 2, added, 2 * seen - added FROM n
  UNION ALL SELECT 'observations', 'completed', 2, fresh, 2 * arrived - fresh FROM n""",
    ),
)
def load_log(t):
    """What the log holds after the same sync ran twice."""
    log = t.spark.table(_synced_twice(t).log)
    return log.groupBy("entity", "status").agg(
        F.count("*").alias("runs"), F.sum("created").alias("created"), F.sum("updated").alias("updated")
    )


WINDOWS = [(dt.date(1996, 1, 1), dt.date(1998, 6, 30)), (None, dt.date(1995, 12, 31))]


def _synced_by_windows(t):
    """Two windows of dates, the later first; one of them again; then all since the newest day."""
    names, regions = _sync_tables(t)
    arriving = t.obs.where("k2 >= 3")
    for n in (0, 1, 0):
        start, end = WINDOWS[n]
        sync.publish_sync(t.spark, names, regions, arriving, _order(), start=start, end=end, load_id=f"window {n}")
    sync.sync_since(t.spark, names, regions, arriving, _order(), overlap_days=30, load_id="rest")
    return names


@query(
    "sync_incremental",
    with_views("stations fact", f"WITH {ALL_SIDES} SELECT {_merge_select()} {FULL_JOIN}"),
)
def sync_incremental(t):
    """The observation table after loads by date windows: as after one full sync."""
    return t.spark.table(_synced_by_windows(t).observations).select(*MERGED)


@query(
    "sync_marks",
    with_views(
        "stations fact",
        f"""WITH {ALL_SIDES}, mark AS (SELECT max(observation_date) AS day FROM incoming WHERE observation_date <= DATE '1998-06-30'),
       came AS (SELECT i.observation_date, t.station_id IS NOT NULL AS there FROM incoming i LEFT JOIN target t
                ON t.station_id = i.station_id AND t.observation_date = i.observation_date),
       part AS (SELECT 'window 0' AS load_id, observation_date, there FROM came WHERE observation_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'
                UNION ALL SELECT 'window 1', observation_date, there FROM came WHERE observation_date <= DATE '1995-12-31'
                UNION ALL SELECT 'rest', observation_date, there OR observation_date <= mark.day FROM came, mark
                          WHERE observation_date >= mark.day - INTERVAL 30 DAY)
  SELECT load_id, 'completed' AS status, CAST(max(observation_date) AS DATE) AS newest,
         count(*) FILTER (NOT there) AS created, count(*) FILTER (there) AS updated
  FROM part GROUP BY load_id""",
    ),
)
def sync_marks(t):
    """What the load log says of the observations of those loads: the repeated one is not in it."""
    log = t.spark.table(_synced_by_windows(t).log).where("entity = 'observations'")
    return log.select("load_id", "status", "newest", "created", "updated")


@query(
    "station_rejects",
    with_views(
        "stations",
        "SELECT CAST(station_id AS VARCHAR) AS station_id, 'latitude is not a number' AS error FROM stations WHERE station_id % 11 = 0",
    ),
)
def station_rejects(t):
    """Rows of the station file that were refused, with the reasons."""
    path = work_path(t.spark, "csv")
    station_text(t).write.option("header", True).csv(path)
    target = _station_target(t).withColumn("station_id", F.col("station_id").cast("string"))
    _, rejects = sync.load_station_text(t.spark, path, target, t.regions)
    return rejects.select("station_id", F.explode("errors").alias("error"))


@query(
    "load_obs_csv",
    with_views(
        "stations fact",
        f"""WITH target AS (SELECT * FROM fact WHERE k2 <= 2 {FIRST_SQL}),
       arriving AS (SELECT *, CASE WHEN k2 = 3 OR station_id NOT IN (SELECT station_id FROM stations WHERE is_active) THEN 'skipped'
                                   WHEN k2 = 4 THEN 'error' END AS early FROM fact WHERE k2 >= 3),
       good AS (SELECT *, station_id IN (SELECT t.station_id FROM target t WHERE t.station_id = arriving.station_id
                       AND t.observation_date = arriving.observation_date) AS there FROM arriving WHERE early IS NULL),
       fresh AS (SELECT DISTINCT station_id, observation_date FROM good WHERE NOT there)
  SELECT early AS action, count(*) AS n FROM arriving WHERE early IS NOT NULL GROUP BY early
  UNION ALL SELECT 'duplicate', count(*) FROM good WHERE there
  UNION ALL SELECT 'created', count(*) FROM fresh""",
    ),
)
def load_obs_csv(t):
    """A delimited file with blank and bad dates, loaded beside rows that are there."""
    k2, day = F.col("k2"), F.date_format("observation_date", "yyyy-MM-dd")
    text_date = (
        F.when(k2 == 3, F.lit(None))
        .when(k2 == 4, F.date_format("observation_date", "dd.MM.yyyy"))
        .when(k2 == 5, F.concat(day, F.lit(" 00:00:00")))
        .otherwise(day)
    )
    rows = t.obs.where("k2 >= 3").select(
        F.col("station_id").cast("string").alias("station_id"),
        text_date.alias("observation_date"),
        F.lit(None).cast("string").alias("year"),
        F.lit(None).cast("string").alias("month"),
        *MEASURES,
        "region",
    )
    path = work_path(t.spark, "csv")
    rows.write.option("header", True).csv(path)
    stations = t.stations.where("is_active").select(F.col("station_id").cast("string").alias("station_id"))
    target = upsert.first_per_key(t.fact.where("k2 <= 2"), sync.OBSERVATION_KEY, _order())
    target = target.select(F.col("station_id").cast("string").alias("station_id"), "observation_date")
    done = sync.load_observation_text(
        t.spark, path, stations, target, [F.col(c) for c in MEASURES]
    )
    return done.groupBy("action").agg(F.count("*").alias("n"))
