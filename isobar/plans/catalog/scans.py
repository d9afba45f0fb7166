"""Scans, exports, statistics, generators, sorts, pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators import clean, ordering
from isobar.operators.aggregates import last_groups
from isobar.plans.adapter import DAY_ORDER, TABLES, with_views
from isobar.plans.catalog.base import query
from isobar.schemas import MEASURES
from isobar.session import work_path, work_table
from isobar.sources import files, generate, tables

SYNC_COLUMNS = [
    "station_id", "observation_date", "year", "month", "temp_max", "temp_min", "temp_mean",
    "precipitation", "humidity", "sea_surface_temp", "ocean_salinity",
]
ORDER_SQL = "observation_date DESC NULLS LAST, station_id, k1, k2, k3"


@query("scan_obs", with_views("fact", f"SELECT {', '.join(SYNC_COLUMNS)} FROM fact"))
def scan_obs(t):
    return t.fact.select(*SYNC_COLUMNS)


def station_text(t):
    """Stations as they might arrive in a file: text, with gaps and bad numbers."""
    k = F.col("station_id")
    return t.stations.select(
        k.cast("string").alias("station_id"),
        F.when(k % 5 == 0, "").otherwise(F.col("station_name")).alias("station_name"),
        F.when(k % 7 != 0, F.col("country")).alias("country"),
        "region",
        F.when(k % 11 == 0, "north").when(k % 4 == 0, "").otherwise("12.5").alias("latitude"),
        F.when(k % 6 == 0, "").otherwise("-7").alias("longitude"),
        F.when(k % 2 == 0, "250.5").alias("elevation"),
        F.element_at(
            F.array(*[F.lit(w) for w in ("True", "1", "yes", "no", "")]), (k % 5 + 1).cast("int")
        ).alias("is_coastal"),
        F.when(k % 3 == 0, "false").when(k % 3 == 1, "YES").alias("is_active"),
    )


@query(
    "csv_coerce",
    with_views(
        "stations",
        """
  SELECT CAST(station_id AS VARCHAR) AS station_id,
         CASE WHEN station_id % 5 = 0 THEN CAST(station_id AS VARCHAR) ELSE station_name END AS station_name,
         CASE WHEN station_id % 7 <> 0 THEN country ELSE 'Unknown' END AS country, region,
         CASE WHEN station_id % 11 = 0 THEN NULL WHEN station_id % 4 = 0 THEN 0 ELSE CAST('12.5' AS DOUBLE) END AS latitude,
         CASE WHEN station_id % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(-7 AS DOUBLE) END AS longitude,
         CASE WHEN station_id % 2 = 0 THEN CAST(250.5 AS DOUBLE) END AS elevation,
         station_id % 5 IN (0, 1, 2) AS is_coastal,
         station_id % 3 <> 0 AS is_active,
         CAST(CASE WHEN station_id % 11 = 0 THEN 1 ELSE 0 END AS INT) AS n_errors
  FROM stations""",
    ),
)
def csv_coerce(t):
    typed = clean.coerce_stations(station_text(t))
    return typed.withColumn("n_errors", F.size("errors")).drop("errors")


EXPORT_SQL = """
  SELECT station_id AS "Station ID", station_name AS "Station Name", country AS "Country",
         region AS "Region", observation_date AS "Date", temp_max AS "Temp Max",
         temp_min AS "Temp Min", temp_mean AS "Temp Mean", precipitation AS "Precipitation",
         humidity AS "Humidity", sea_surface_temp AS "SST", ocean_salinity AS "Salinity"
  FROM obs"""


def _exported(t, rows):
    """Written as CSV by the exporter's writer and read back."""
    path = work_path(t.spark, "export")
    files.export(rows, path, "csv")
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


@query(
    "export_obs",
    with_views(
        "obs",
        f"{EXPORT_SQL} WHERE year >= 1996 AND region IN (SELECT min(region) FROM obs) ORDER BY {ORDER_SQL} LIMIT 1000",
    ),
)
def export_obs(t):
    """The newest thousand rows that a filter spec lets through, as the export page gives them."""
    region = t.stations.agg(F.min("region")).first()[0]
    spec = {"year__gte": 1996, "region": region}
    return _exported(t, files.export_rows(t.obs, spec, 1000, DAY_ORDER))


@query("export_all", with_views("obs", EXPORT_SQL))
def export_all(t):
    """Every row, no limit."""
    return _exported(t, files.export_rows(t.obs))


SQL_TEXT = """
  SELECT o_orderpriority, count(*) AS n, CAST(round(CAST(sum(o_totalprice) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total
  FROM {orders} GROUP BY o_orderpriority"""


@query("sql_to_df", SQL_TEXT.replace("{orders}", "orders"))
def sql_to_df(t):
    return files.run_sql(t.spark, SQL_TEXT, orders=t.table("orders"))


# Columns with a range in the catalog's statistics, and those without: text and dates.
STATS_COLUMNS = ["k1", "k2", "k3", "station_id", "year", "month", *MEASURES]
STATS_OTHERS = ["observation_date", "data_quality"]


@query(
    "table_stats",
    with_views(
        "fact",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, "
            f"count(*) - count({c}) AS null_count, CAST(min({c}) AS DOUBLE) AS min_value, "
            f"CAST(max({c}) AS DOUBLE) AS max_value FROM fact"
            for c in STATS_COLUMNS
        )
        + "".join(
            f" UNION ALL SELECT '{c}', count(*), count(*) - count({c}), NULL, NULL FROM fact" for c in STATS_OTHERS
        ),
    ),
)
def table_stats(t):
    """Statistics the catalog holds after ANALYZE of a table with all observations."""
    name = work_table("isobar_stats")
    rows = t.fact.select(*STATS_COLUMNS, *STATS_OTHERS)
    tables.load_table(rows, name, path=work_path(t.spark, "stats"))
    return tables.table_stats(t.spark, name).drop("distinct_estimate")


@query(
    "table_partition_stats",
    with_views("obs", "SELECT 'year=' || year || '/region=' || region AS partition, count(*) AS row_count FROM obs GROUP BY year, region"),
)
def table_partition_stats(t):
    """Rows of every partition of the published layout, from the catalog."""
    name = work_table("isobar_partitions")
    rows = t.obs.select("station_id", "observation_date", "temp_mean", "year", "region")
    tables.write_warehouse(rows, name, buckets=None, path=work_path(t.spark, "partitions"))
    return tables.partition_stats(t.spark, name).drop("bytes")


@query(
    "table_histogram",
    with_views("fact", "SELECT count(temp_mean) AS n, min(temp_mean) AS low, max(temp_mean) AS high, true AS even FROM fact"),
)
def table_histogram(t):
    """The equal-height histogram of temperatures: what its bins hold together, and whether each holds its share.

    A bin may hold more only where one reading alone does, and the bounds are estimates.
    """
    name = work_table("isobar_histogram")
    tables.load_table(t.fact.select("temp_mean"), name, path=work_path(t.spark, "histogram"))
    bins = tables.histogram(t.spark, name, "temp_mean")
    # Bins between the same bounds are one; a reading on a bound may lie on either side.
    bins = bins.groupBy("low", "high").agg(F.sum("height").alias("height"))
    v, rows = F.col("temp_mean"), t.spark.table(name)
    counts = rows.groupBy("temp_mean").agg(F.count("*").alias("c"))
    spans = bins.withColumn("v", F.explode(F.sequence(F.floor("low"), F.ceil("high")))).select("low", "high", "height", "v")
    held = spans.join(counts, (F.floor("temp_mean") == F.col("v")) & (v >= F.col("low")) & (v <= F.col("high")))
    held = held.groupBy("low", "high", "height").agg(F.sum("c").alias("most"), F.sum(F.when((v > F.col("low")) & (v < F.col("high")), F.col("c")).otherwise(0)).alias("least"))
    total = F.sum("height")
    slack = 0.02 * rows.count()
    even = F.bool_and((F.col("most") >= F.col("height") - slack) & (F.col("least") <= F.col("height") + slack))
    return held.agg(F.round(total).cast("long").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), even.alias("even"))


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES
)


@query("table_counts", COUNTS_SQL)
def table_counts(t):
    return tables.table_counts({n: t.table(n) for n in TABLES})


@query(
    "storage_report",
    with_views(
        "obs",
        " UNION ALL ".join(
            f"SELECT '{f}' AS format, count(*) AS rows, CAST(round(CAST(sum(temp_mean) AS DECIMAL(38,6)), 2) AS DOUBLE) AS temp_total, "
            "count(precipitation) AS with_precipitation, CAST(sum(k1) AS BIGINT) AS keys_total, true AS has_bytes FROM obs"
            for f in tables.STORAGE_FORMATS
        ),
    ),
)
def storage_report(t):
    """Every format of the report read back; the sizes themselves are tested apart."""
    path = work_path(t.spark, "storage")
    sizes = tables.storage_report(t.obs, path).select("format", (F.col("bytes") > 0).alias("has_bytes"))
    return tables.storage_contents(t.spark, path, t.obs.schema).join(sizes, "format")


@query(
    "external_scan",
    with_views("stations", "SELECT station_id, station_name, country, latitude, true AS files_stay FROM stations"),
)
def external_scan(t):
    """A catalog table over delimited files; dropped again, the files stay."""
    rows = t.plain_stations.select("station_id", "station_name", "country", "latitude")
    path, name = work_path(t.spark, "external"), work_table("isobar_external")
    rows.write.option("header", True).csv(path)
    kept = files.external_table(t.spark, name, rows.schema, path)
    # What the table gives is kept, so that it can be dropped before the result is read.
    held = work_path(t.spark, "external-rows")
    kept.write.parquet(held)
    t.spark.sql(f"DROP TABLE {name}")
    back = t.spark.read.schema(rows.schema).parquet(held)
    there = files.read_csv(t.spark, path, rows.schema).count()
    return back.withColumn("files_stay", F.lit(there == back.count()))


# -- generators: the same digests taken in SQL -------------------------------

G = generate
PER_STATION = 50


def _u(key: str, seed: int, draw: int) -> str:
    digest = f"md5(concat_ws('#', {key}, '{seed}', '{draw // 4}'))"
    return f"(CAST('0x' || substr({digest}, {8 * (draw % 4) + 1}, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _near(expr: str, places: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def _span(u: str, low, high) -> str:
    return f"CAST({low} AS DOUBLE) + {u} * (CAST({high} AS DOUBLE) - CAST({low} AS DOUBLE))"


def _pick(items, u: str) -> str:
    listed = "[" + ", ".join(f"'{i}'" for i in items) + "]"
    return f"{listed}[CAST(floor({u} * {len(items)}) AS INT) + 1]"


def _by_region(value) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {value(p)}" for n, p in G.REGION_PROFILES.items())
    return f"CASE region {cases} END"


def _stations_made(seed: int = 7) -> str:
    def u(draw):
        return _u("i", seed, G.STATION_DRAWS.index(draw))

    return f"""
  placed AS (SELECT s_suppkey AS i, {_pick(G.REGION_PROFILES, _u('s_suppkey', seed, 0))} AS region FROM supplier),
  coded AS (SELECT *, {_by_region(lambda p: _pick(p[0].split(), u('country')))} AS country FROM placed),
  named AS (SELECT *, country || '-' || upper(substr(region, 1, 3)) || '-' || printf('%05d', i) AS station_id FROM coded),
  made AS (
    SELECT station_id, 'Station ' || station_id AS station_name, country, region,
           {_near(_by_region(lambda p: _span(u('lat'), *p[1])), 4)} AS latitude,
           {_near(_by_region(lambda p: _span(u('lon'), *p[2])), 4)} AS longitude,
           {_near(_span(u('elevation'), 0, 3000), 1)} AS elevation,
           {u('coastal')} < CAST({G.COASTAL_SHARE} AS DOUBLE) AS is_coastal,
           {u('active')} < CAST({G.ACTIVE_SHARE} AS DOUBLE) AS is_active
    FROM named)"""


def _observations_made(seed: int = 7) -> str:
    def u(draw):
        return _u("key", seed, G.OBSERVATION_DRAWS.index(draw))

    total = 16437  # days from 1980 to 2024
    wet = ", ".join(f"'{w}'" for w in G.WET_REGIONS)
    return f"""
  slots AS (SELECT station_id, region, is_coastal, k, concat_ws('#', station_id, k) AS key,
                   floor(k * {total} / {PER_STATION}) AS low, floor((k + 1) * {total} / {PER_STATION}) AS high
            FROM made, range(0, {PER_STATION}) s(k)),
  dated AS (SELECT *, DATE '1980-01-01' + CAST(low + floor({u('day')} * (high - low)) AS INT) AS observation_date,
                   {_by_region(lambda p: f'CAST({p[3]} AS DOUBLE)')} + ({_span(u('mean'), -10, 15)}) AS mean FROM slots)
  SELECT station_id, observation_date, CAST(year(observation_date) AS INT) AS year, CAST(month(observation_date) AS INT) AS month,
         {_near(f"mean + ({_span(u('up'), 2, 8)})", 1)} AS temp_max, {_near(f"mean - ({_span(u('down'), 2, 8)})", 1)} AS temp_min,
         {_near('mean', 1)} AS temp_mean,
         {_near(f"least(-(CAST(CASE WHEN region IN ({wet}) THEN 100 ELSE 30 END AS DOUBLE) / 3) * ln(1 - {u('rain')}), 500)", 1)} AS precipitation,
         {_near(_span(u('humidity'), 40, 95), 1)} AS humidity,
         CASE WHEN is_coastal THEN {_near(_span(u('sst'), 18, 28), 1)} END AS sea_surface_temp,
         CASE WHEN is_coastal THEN {_near(_span(u('salinity'), 33, 37), 1)} END AS ocean_salinity, region
  FROM dated"""


def _dated_made(spans: dict, seed: int) -> str:
    key = "o_orderkey"
    values = ", ".join(
        f"{_near(_span(_u(key, seed, n), a, b), 2)} AS {name}" for n, (name, (a, b)) in enumerate(spans.items(), 2)
    )
    days = 1827  # days from 2020 to 2024
    return (
        f"SELECT DATE '2020-01-01' + CAST(floor({_u(key, seed, 0)} * {days}) AS INT) AS date, "
        f"{_pick(G.REGION_PROFILES, _u(key, seed, 1))} AS region, {values} FROM orders"
    )


@query("gen_stations", f"WITH {_stations_made()} SELECT * FROM made")
def gen_stations(t):
    """One generated station per supplier."""
    return generate.gen_stations(t.table("supplier"), id_col="s_suppkey")


@query("gen_obs", f"WITH {_stations_made()}, {_observations_made().strip()}")
def gen_obs(t):
    """Generated observations for the stations generated from the suppliers."""
    made = generate.gen_stations(t.table("supplier"), id_col="s_suppkey")
    return generate.gen_obs(made, PER_STATION)


@query("gen_climate", _dated_made(G.CLIMATE_SPANS, 7))
def gen_climate(t):
    return generate.gen_climate(t.table("orders"), id_col="o_orderkey")


@query("gen_ocean", _dated_made(G.OCEAN_SPANS, 8))
def gen_ocean(t):
    return generate.gen_ocean(t.table("orders"), id_col="o_orderkey")


@query(
    "sort_multi",
    with_views(
        "obs",
        "SELECT country, year, count(*) AS n FROM obs GROUP BY country, year "
        "ORDER BY n DESC, country, year DESC",
    ),
)
def sort_multi(t):
    n = t.obs.groupBy("country", "year").agg(F.count("*").alias("n"))
    return ordering.sort_multi(n, F.desc("n"), F.asc("country"), F.desc("year"))


NEWEST_SQL = f"SELECT * FROM fact %s ORDER BY {ORDER_SQL} LIMIT %d"


@query("topk_hot", with_views("fact", NEWEST_SQL % ("WHERE temp_mean > 30", 20_000)))
def topk_hot(t):
    """A large k: the day of the k-th row is found before anything is sorted."""
    return ordering.newest(t.fact.where(F.col("temp_mean") > 30), 20_000, DAY_ORDER)


@query("latest_k", with_views("fact", NEWEST_SQL % ("", 10)))
def latest_k(t):
    return ordering.newest(t.fact, 10, DAY_ORDER)


@query(
    "last_years",
    with_views(
        "fact",
        "SELECT * FROM (SELECT year, count(*) AS n FROM fact GROUP BY year "
        "ORDER BY year DESC LIMIT 5) ORDER BY year",
    ),
)
def last_years(t):
    return last_groups(t.fact.groupBy("year").agg(F.count("*").alias("n")), "year", 5)


@query(
    "distribute_sort",
    with_views(
        "obs",
        "SELECT region, station_id, month, count(*) AS n, max(temp_max) AS max_temp "
        "FROM obs GROUP BY region, station_id, month",
    ),
)
def distribute_sort(t):
    rows = t.obs.groupBy("region", "station_id", "month").agg(
        F.count("*").alias("n"), F.max("temp_max").alias("max_temp")
    )
    return ordering.distribute_sort(rows, ["region"], ["station_id", "month"])


@query("page", with_views("fact", NEWEST_SQL % ("", 100) + " OFFSET 200"))
def page(t):
    return ordering.page(t.fact, DAY_ORDER, 3, 100)


@query("page_far", with_views("fact", NEWEST_SQL % ("", 100) + " OFFSET 30000"))
def page_far(t):
    """A page far from the start: only the days it lies in are sorted."""
    return ordering.page(t.fact, DAY_ORDER, 301, 100)


@query(
    "page_stations",
    with_views("stations", "SELECT * FROM stations ORDER BY station_name, station_id LIMIT 7 OFFSET 7"),
)
def page_stations(t):
    return ordering.page_by(t.plain_stations, [F.asc("station_name"), F.asc("station_id")], 2, 7)


UNION_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ("stations", "fact", "regions")
)


@query("union_counts", with_views("stations fact regions", UNION_SQL))
def union_counts(t):
    def one(name, df):
        return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return ordering.union_all(
        one("stations", t.stations), one("fact", t.fact), one("regions", t.regions)
    )


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(t):
    return ordering.distinct_rows(t.table("part"), "p_brand", "p_type")


@query(
    "split_by_time",
    with_views(
        "fact",
        f"""
  SELECT split, count(*) AS n, min(observation_date) AS first_day, max(observation_date) AS last_day,
         CAST(sum(k1) AS BIGINT) AS key_sum
  FROM (SELECT *, CASE WHEN row_number() OVER (ORDER BY {ORDER_SQL})
                       <= (SELECT floor(count(*) * CAST(0.8 AS DOUBLE)) FROM fact) THEN 'train' ELSE 'test' END AS split
        FROM fact)
  GROUP BY split""",
    ),
)
def split_by_time(t):
    """Which rows each side holds, as counts, days and a key sum."""

    def held(side, name):
        return side.agg(
            F.count("*").alias("n"),
            F.min("observation_date").alias("first_day"),
            F.max("observation_date").alias("last_day"),
            F.sum("k1").alias("key_sum"),
        ).select(F.lit(name).alias("split"), "*").where("n > 0")

    train, test = ordering.split_frames(t.fact, 0.8, DAY_ORDER)
    return held(train, "train").unionByName(held(test, "test"))
