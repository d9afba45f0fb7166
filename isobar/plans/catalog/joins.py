"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators import assess, joins
from isobar.plans.adapter import r, with_views
from isobar.plans.catalog.base import query, rounded
from isobar.session import work_path, work_table
from isobar.sources import tables

COUNTRY_REGION_SQL = with_views(
    "obs",
    f"SELECT country, region, count(*) AS n, {r('avg(temp_mean)', 6)} AS avg_temp "
    "FROM obs GROUP BY country, region",
)


@query(
    "join_country_year",
    with_views(
        "obs",
        f"SELECT country, year, {r('avg(sea_surface_temp)', 6)} AS avg_sst "
        "FROM obs WHERE is_active GROUP BY country, year",
    ),
)
def join_country_year(t):
    return rounded(joins.country_year_sst(t.fact, t.stations), 6, "avg_sst")


@query("join_broadcast", COUNTRY_REGION_SQL)
def join_broadcast(t):
    return rounded(joins.country_region_broadcast(t.fact, t.stations), 6, "avg_temp")


@query("join_shuffle", COUNTRY_REGION_SQL)
def join_shuffle(t):
    return rounded(joins.country_region_shuffle(t.fact, t.plain_stations), 6, "avg_temp")


@query("join_bucketed", COUNTRY_REGION_SQL)
def join_bucketed(t):
    """Both tables written bucketed by station, then joined without a shuffle."""
    fact, dim, hot = tables.bucketed_pair(
        t.fact.select("station_id", "temp_mean"),
        t.plain_stations.select("station_id", "country", "region"),
        "station_id",
        work_table("isobar_obs"),
        work_table("isobar_stations"),
        fact_path=work_path(t.spark, "obs"),
        dim_path=work_path(t.spark, "stations"),
    )
    return rounded(joins.country_region_bucketed(fact, dim, hot), 6, "avg_temp")


@query(
    "enrich_obs",
    with_views(
        "obs baselines",
        f"""
  SELECT k1, k2, k3, station_id, country, o.region, latitude, longitude, baseline_temp,
         temp_mean - baseline_temp AS temp_anomaly,
         {r('sin(2 * pi() * month / 12)', 9)} AS month_sin, {r('cos(2 * pi() * month / 12)', 9)} AS month_cos
  FROM obs o LEFT JOIN baselines b ON o.region = b.region""",
    ),
)
def enrich_obs(t):
    rows = joins.enrich(t.fact, t.stations, t.baselines).select(
        "k1", "k2", "k3", "station_id", "country", "region", "latitude", "longitude",
        "baseline_temp", "temp_anomaly", "month_sin", "month_cos",
    )
    return rounded(rows, 9, "month_sin", "month_cos")


@query(
    "rain_vs_salinity",
    with_views(
        "obs",
        f"""
  SELECT c.region, c.observation_date AS date, CAST(count(*) AS DECIMAL(38, 0)) AS pairs,
         {r('avg(c.precipitation)', 6)} AS avg_rainfall, max(c.precipitation) AS max_rainfall,
         {r('avg(o.ocean_salinity)', 6)} AS avg_salinity, min(o.ocean_salinity) AS min_salinity
  FROM obs c JOIN obs o ON c.observation_date = o.observation_date AND c.region = o.region
  WHERE c.precipitation > 50 AND o.ocean_salinity < 35
  GROUP BY c.region, c.observation_date""",
    ),
)
def rain_vs_salinity(t):
    climate = t.obs.select(
        F.col("observation_date").alias("date"), "region", F.col("precipitation").alias("rainfall")
    )
    ocean = t.obs.select(
        F.col("observation_date").alias("date"), "region", F.col("ocean_salinity").alias("salinity")
    )
    out = joins.rain_vs_salinity(climate, ocean, 50.0, 35.0)
    return rounded(out, 6, "avg_rainfall", "avg_salinity")


@query(
    "join_fact_fact",
    with_views(
        "fact",
        f"""
  SELECT a.station_id, CAST(count(*) AS DECIMAL(38, 0)) AS pairs, {r('sum(a.temp_mean)', 1)} AS sum_temp,
         {r('sum(b.precipitation)', 1)} AS sum_precip,
         {r('avg(a.temp_mean)', 4)} AS avg_temp, {r('avg(b.precipitation)', 4)} AS avg_precip
  FROM fact a JOIN fact b ON a.station_id = b.station_id
  WHERE a.year >= 1998 GROUP BY a.station_id""",
    ),
)
def join_fact_fact(t):
    out = joins.fact_by_fact(t.fact, t.fact, 1998, "observation_date")
    return rounded(rounded(out, 1, "sum_temp", "sum_precip"), 4, "avg_temp", "avg_precip")


@query(
    "star_revenue",
    f"""
  SELECT c_mktsegment, p_type, {r('sum(l_extendedprice * (1 - l_discount))', 2)} AS revenue,
         count(*) AS lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
  GROUP BY c_mktsegment, p_type""",
)
def star_revenue(t):
    """Reduced to (customer, type) before the customers are joined."""
    orders = t.table("orders").where(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    per_customer = joins.star(
        t.table("lineitem"),
        [
            (orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")),
            (t.table("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")),
        ],
        ["o_custkey", "p_type"],
        [
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.count("*").alias("lines"),
        ],
    )
    out = joins.star(
        per_customer,
        [(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))],
        ["c_mktsegment", "p_type"],
        [F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")],
    )
    return rounded(out, 2, "revenue")


@query(
    "obs_with_station",
    with_views(
        "obs regions",
        """
  SELECT k1, k2, k3, station_id, station_name, country, region, code AS region_code, latitude, longitude,
         observation_date, year, month, temp_max, temp_min, temp_mean, precipitation, humidity,
         sea_surface_temp, ocean_salinity, data_quality
  FROM obs JOIN regions ON obs.region = regions.name""",
    ),
)
def obs_with_station(t):
    return joins.with_station(t.fact, t.stations, t.regions)


@query(
    "station_obs_count",
    with_views(
        "stations fact",
        """
  SELECT s.station_id, s.country, count(f.k1) AS observation_count
  FROM (SELECT station_id, country FROM stations UNION ALL SELECT -c_custkey, CAST(NULL AS VARCHAR) FROM customer) s
       LEFT JOIN fact f ON s.station_id = f.station_id
  GROUP BY s.station_id, s.country""",
    ),
)
def station_obs_count(t):
    """Observations per station; customers stand for stations that have none."""
    silent = t.table("customer").select(
        (-F.col("c_custkey")).alias("station_id"), F.lit(None).cast("string").alias("country")
    )
    return joins.station_counts(t.plain_stations.select("station_id", "country").unionByName(silent), t.fact)


@query(
    "orphans",
    with_views(
        "stations fact",
        """
  SELECT CASE WHEN s.station_id IS NULL THEN 'skipped' ELSE 'kept' END AS kind, count(*) AS n,
         count(DISTINCT f.station_id) AS stations
  FROM fact f LEFT JOIN (SELECT station_id FROM stations WHERE is_active) s ON f.station_id = s.station_id
  GROUP BY 1""",
    ),
)
def orphans(t):
    """Observations of active stations are kept, the others skipped."""
    return joins.orphan_counts(t.fact, t.stations.where("is_active"))


@query(
    "orphan_rows",
    with_views(
        "stations fact",
        "SELECT k1, k2, k3, station_id FROM fact "
        "WHERE station_id NOT IN (SELECT station_id FROM stations WHERE is_active)",
    ),
)
def orphan_rows(t):
    skipped = joins.split_known(t.fact, t.stations.where("is_active"))[1]
    return skipped.select("k1", "k2", "k3", "station_id")


@query(
    "split_existing",
    "SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS exists FROM orders",
)
def split_existing(t):
    target = t.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    incoming = t.table("orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    return joins.flag_existing(incoming, target, ["key"]).drop("key")


RULES_SQL = (
    "rules(scenario_type, setting, value, reason, priority) AS (VALUES "
    + ", ".join(
        "(" + ", ".join(f"'{v}'" for v in (*rule, assess.RULE_PRIORITY)) + ")"
        for rule in assess.RULES
    )
    + ")"
)


@query(
    "recommend",
    with_views(
        "runs",
        f"WITH {RULES_SQL} SELECT run_id, scenario, scenario_type, executed_at, setting, value, reason, priority "
        "FROM runs JOIN rules USING (scenario_type)",
    ),
)
def recommend(t):
    return assess.recommend(t.runs, assess.rules(t.spark))
