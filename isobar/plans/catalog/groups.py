"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators import aggregates as A
from isobar.operators import filters, joins, sketches
from isobar.operators.skew import salted_avg
from isobar.plans.adapter import r, with_views
from isobar.plans.catalog.base import query, rounded
from isobar.session import work_path, work_table

N = "count(*) AS observation_count"


def avg(c: str, name: str, places: int = 6) -> str:
    return f"{r(f'avg({c})', places)} AS {name}"


def total(c: str, name: str, places: int = 2) -> str:
    return f"{r(f'sum({c})', places)} AS {name}"


@query("count_all", with_views("fact", "SELECT count(*) AS n FROM fact"))
def count_all(t):
    return A.count_all(t.fact)


@query(
    "region_avg",
    with_views("obs", f"SELECT region, {N}, {avg('temp_mean', 'avg_temp')}, {avg('precipitation', 'avg_precip')} FROM obs GROUP BY region"),
)
def region_avg(t):
    return rounded(A.region_avg(t.obs), 6, "avg_temp", "avg_precip")


@query(
    "region_month",
    with_views("obs", f"SELECT region, month, {avg('temp_mean', 'avg_temp')}, {total('precipitation', 'total_precip')} FROM obs GROUP BY region, month"),
)
def region_month(t):
    return rounded(rounded(A.region_month(t.obs), 6, "avg_temp"), 2, "total_precip")


@query(
    "year_month_region",
    with_views(
        "obs",
        f"SELECT year, month, region, {avg('temp_mean', 'avg_temp')}, {avg('humidity', 'avg_humidity')}, "
        f"{total('precipitation', 'total_precip')} FROM obs GROUP BY year, month, region",
    ),
)
def year_month_region(t):
    return rounded(rounded(A.year_month_region(t.obs), 6, "avg_temp", "avg_humidity"), 2, "total_precip")


@query(
    "year_trend",
    with_views("fact", f"SELECT year, {avg('temp_mean', 'avg_temp')}, max(temp_max) AS max_temp, min(temp_min) AS min_temp FROM fact GROUP BY year"),
)
def year_trend(t):
    return rounded(A.year_trend(t.fact), 6, "avg_temp")


@query(
    "region_stats",
    with_views(
        "obs",
        f"""
  SELECT region, {r('stddev_pop(temp_max - temp_min)', 6)} AS range_stddev,
         {r('corr(humidity, precipitation)', 6)} AS humidity_precip_corr,
         median(temp_mean) AS median_temp, min(temp_min) AS min_temp, max(temp_max) AS max_temp
  FROM obs GROUP BY region""",
    ),
)
def region_stats(t):
    return rounded(A.region_stats(t.obs, exact=True), 6, "range_stddev", "humidity_precip_corr")


@query("region_stats_sketch")
def region_stats_sketch(t):
    """The one-pass form, with the median from a bounded sketch."""
    return rounded(A.region_stats(t.obs), 6, "range_stddev", "humidity_precip_corr")


YEARS = (1994, 1997)


def _sketched(t):
    """Sketches of all years, one of them replaced, and what they say of a range."""
    name = work_table("isobar_sketches")
    sketches.create(t.obs, name, work_path(t.spark, "sketches"))
    sketches.refresh(t.obs.where("year = 1996"), name)
    return sketches.over_years(t.spark, name, *YEARS)


@query(
    "median_sketch",
    with_views(
        "obs", f"SELECT region, count(*) AS n, true AS holds FROM obs WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY region"
    ),
)
def median_sketch(t):
    """Medians of four years from stored sketches, and whether their ranks are within the bound."""
    said = _sketched(t).select(F.col("region").alias("_region"), "median", "rows")
    rows = filters.year_range(t.obs, *YEARS).where(F.col("temp_mean").isNotNull())
    v = F.col("temp_mean")
    ranks = rows.join(said, F.col("region").eqNullSafe(F.col("_region"))).groupBy("region").agg(
        F.max("rows").alias("n"), F.count("*").alias("_n"),
        F.count_if(v < F.col("median")).alias("_below"), F.count_if(v <= F.col("median")).alias("_upto"),
    )
    return ranks.select("region", "n", sketches.median_holds(F.col("_below"), F.col("_upto"), F.col("_n")).alias("holds"))


@query(
    "stations_sketch",
    with_views(
        "obs",
        f"SELECT region, count(DISTINCT station_id) AS stations, true AS holds FROM obs "
        f"WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY region",
    ),
)
def stations_sketch(t):
    """Distinct stations of four years, exact, and whether the stored sketches say the same within the bound."""
    said = _sketched(t).select(F.col("region").alias("_region"), "keys")
    seen = filters.year_range(t.fact, *YEARS).select("station_id").distinct()
    exact = seen.join(t.stations.select("station_id", "region"), "station_id").groupBy("region").agg(F.count("*").alias("stations"))
    off = F.abs(F.col("keys") - F.col("stations")) / F.col("stations")
    return exact.join(said, F.col("region").eqNullSafe(F.col("_region"))).select(
        "region", "stations", (off <= sketches.COUNT_ERROR).alias("holds")
    )


@query(
    "coverage",
    with_views(
        "obs",
        "SELECT count(DISTINCT station_id) AS stations, count(DISTINCT year) AS years, "
        "count(DISTINCT region) AS regions, count(DISTINCT country) AS countries FROM obs",
    ),
)
def coverage(t):
    return A.coverage(t.fact, t.stations)


@query(
    "region_summary",
    with_views(
        "obs",
        f"SELECT region, count(DISTINCT station_id) AS station_count, {N}, {avg('temp_mean', 'avg_temp')}, "
        f"{avg('humidity', 'avg_humidity')}, {total('precipitation', 'total_precip')} FROM obs GROUP BY region",
    ),
)
def region_summary(t):
    return rounded(
        rounded(A.region_summary(t.fact, t.stations), 6, "avg_temp", "avg_humidity"), 2, "total_precip"
    )


@query(
    "region_year_detail",
    with_views(
        "obs",
        f"SELECT region, year, {N}, {avg('temp_mean', 'avg_temp')}, min(temp_mean) AS min_temp, max(temp_mean) AS max_temp, "
        f"{r('stddev_samp(temp_mean)', 6)} AS temp_stddev FROM obs GROUP BY region, year",
    ),
)
def region_year_detail(t):
    return rounded(A.region_year_detail(t.obs), 6, "avg_temp", "temp_stddev")


@query(
    "country_region",
    with_views("obs", f"SELECT country, region, {N}, {avg('temp_mean', 'avg_temp')} FROM obs GROUP BY country, region"),
)
def country_region(t):
    return rounded(A.country_region(t.obs), 6, "avg_temp")


@query(
    "api_temp_trends",
    with_views(
        "obs",
        f"SELECT year, region, {avg('temp_max', 'avg_temp_max', 2)}, {avg('temp_min', 'avg_temp_min', 2)}, "
        f"{avg('temp_mean', 'avg_temp_mean', 2)} FROM obs WHERE year BETWEEN 1996 AND 2000 GROUP BY year, region",
    ),
)
def api_temp_trends(t):
    return A.temp_trends(t.obs, 1996, 2000)


@query(
    "api_precip",
    with_views(
        "obs",
        f"SELECT region, CAST(1998 AS INT) AS year, {total('precipitation', 'total_precipitation')}, "
        f"{avg('precipitation', 'avg_precipitation', 2)}, {N} FROM obs "
        "WHERE year = 1998 AND precipitation IS NOT NULL GROUP BY region",
    ),
)
def api_precip(t):
    return A.precipitation_by_region(t.obs, 1998)


MONTH_SQL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month] AS month_name"


@query(
    "api_ocean",
    with_views(
        "fact",
        f"SELECT month, {MONTH_SQL}, {avg('sea_surface_temp', 'avg_sst', 2)}, {avg('ocean_salinity', 'avg_salinity', 2)}, "
        "count(DISTINCT station_id) AS station_count FROM fact WHERE year = 1998 AND sea_surface_temp IS NOT NULL GROUP BY month",
    ),
)
def api_ocean(t):
    return A.ocean_conditions(t.fact, 1998)


@query(
    "dashboard_stats",
    with_views(
        "stations fact regions",
        """
  SELECT (SELECT count(*) FROM stations WHERE is_active) AS stations,
         (SELECT count(DISTINCT country) FROM stations) AS countries, n AS observations,
         CAST(year(first_day) AS INT) AS min_year, CAST(year(last_day) AS INT) AS max_year,
         (SELECT count(*) FROM regions) AS regions, n * CAST(0.0005 AS DOUBLE) AS size_mb
  FROM (SELECT count(*) AS n, min(observation_date) AS first_day, max(observation_date) AS last_day FROM fact)""",
    ),
)
def dashboard_stats(t):
    return A.dashboard_stats(t.fact, t.stations, t.regions)


PIVOT = ["africa", "america", "asia", "europe", "middle", "oceania"]


def _pivot_cell(name: str) -> str:
    return (
        f"coalesce(max(CASE WHEN split_part(lower(region), ' ', 1) = '{name}' THEN a END), 0) AS {name}"
    )


@query(
    "anomaly_pivot",
    with_views(
        "obs",
        f"""WITH cells AS (
    SELECT year, region, {r('avg(temp_mean) - (SELECT avg(temp_mean) FROM obs)', 1)} AS a
    FROM obs WHERE temp_mean IS NOT NULL GROUP BY year, region)
  SELECT * FROM (SELECT year, {', '.join(_pivot_cell(c) for c in PIVOT)}
                 FROM cells GROUP BY year ORDER BY year DESC LIMIT 5) ORDER BY year""",
    ),
)
def anomaly_pivot(t):
    """Five last years; one pivot column names a region without rows."""
    return A.anomaly_pivot(t.obs, PIVOT, 5)


@query(
    "precip_region",
    with_views(
        "obs",
        f"""
  SELECT CASE WHEN contains(region, 'Africa') THEN region ELSE region || ' Africa' END AS region,
         CAST(a AS BIGINT) AS actual, CAST(trunc(a * CAST(0.98 AS DOUBLE)) AS BIGINT) AS actual_x0_98,
         CAST(trunc(a * CAST(1.1 AS DOUBLE)) AS BIGINT) AS actual_x1_10
  FROM (SELECT region, {r('avg(precipitation) * 12', 0)} AS a FROM obs WHERE precipitation IS NOT NULL GROUP BY region)""",
    ),
)
def precip_region(t):
    return A.precip_outlook(t.obs)


@query(
    "ocean_month",
    with_views(
        "fact",
        f"SELECT month, {MONTH_SQL}, {avg('sea_surface_temp', 'sst', 1)}, {avg('ocean_salinity', 'salinity', 1)} "
        "FROM fact WHERE sea_surface_temp IS NOT NULL GROUP BY month",
    ),
)
def ocean_month(t):
    return A.ocean_by_month(t.fact)


@query(
    "regions_overview",
    with_views(
        "stations fact regions",
        """
  SELECT name, code, count(DISTINCT s.station_id) AS station_count, count(f.k1) AS observation_count
  FROM (SELECT name, code FROM regions UNION ALL SELECT n_name, upper(substr(n_name, 1, 10)) FROM nation) r
       LEFT JOIN stations s ON name = s.region
       LEFT JOIN fact f ON s.station_id = f.station_id
  GROUP BY name, code""",
    ),
)
def regions_overview(t):
    """All regions; nations stand for regions without stations."""
    empty = t.table("nation").select(
        F.col("n_name").alias("name"), F.upper(F.substring("n_name", 1, 10)).alias("code"),
        F.lit(None).cast("string").alias("description"),
    )
    return A.regions_overview(t.regions.unionByName(empty), t.stations, t.fact)


@query(
    "region_coverage_pct",
    with_views(
        "obs",
        f"SELECT region, {N}, {r('count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM obs)', 2)} AS percent FROM obs GROUP BY region",
    ),
)
def region_coverage_pct(t):
    return A.region_share(t.obs)


@query(
    "station_stats",
    with_views(
        "fact",
        f"SELECT station_id, count(*) AS total_observations, {avg('temp_mean', 'avg_temp')}, {avg('precipitation', 'avg_precipitation')}, "
        f"{avg('humidity', 'avg_humidity')}, min(observation_date) AS min_date, max(observation_date) AS max_date FROM fact GROUP BY station_id",
    ),
)
def station_stats(t):
    return rounded(A.station_stats(t.fact), 6, "avg_temp", "avg_precipitation", "avg_humidity")


@query(
    "station_extremes",
    with_views(
        "fact",
        f"SELECT station_id, {avg('temp_mean', 'avg_temp')}, {avg('precipitation', 'avg_precip')}, {avg('humidity', 'avg_humidity')}, "
        "min(temp_min) AS min_temp, max(temp_max) AS max_temp, count(*) AS total_observations FROM fact GROUP BY station_id",
    ),
)
def station_extremes(t):
    return rounded(A.station_extremes(t.fact), 6, "avg_temp", "avg_precip", "avg_humidity")


@query(
    "station_monthly",
    with_views(
        "fact",
        f"SELECT station_id, month, {avg('temp_mean', 'avg_temp')}, {avg('precipitation', 'avg_precip')} FROM fact GROUP BY station_id, month",
    ),
)
def station_monthly(t):
    return rounded(A.station_monthly(t.fact), 6, "avg_temp", "avg_precip")


@query(
    "stations_distinct",
    with_views(
        "obs",
        "SELECT station_id, station_name, country, region, latitude, longitude, max(sea_surface_temp) AS max_sst, "
        "max(sea_surface_temp) IS NOT NULL AS is_coastal FROM obs GROUP BY ALL",
    ),
)
def stations_distinct(t):
    return A.stations_distinct(t.obs)


@query(
    "countries",
    with_views("stations", "SELECT country, count(*) OVER () AS n_countries FROM (SELECT DISTINCT country FROM stations)"),
)
def countries(t):
    return A.countries(t.stations)


@query(
    "month_region_2024",
    with_views(
        "obs",
        f"SELECT region, month, {avg('temp_mean', 'avg_temp', 2)}, {avg('precipitation', 'avg_precip', 2)}, {N} "
        "FROM obs WHERE year = 1997 AND temp_mean IS NOT NULL GROUP BY region, month",
    ),
)
def month_region_2024(t):
    """Monthly means of one year; the driver's data end before 2024."""
    return A.month_region(t.obs, 1997)


@query(
    "country_extremes",
    with_views(
        "obs",
        "SELECT country, max(temp_max) AS hottest_recorded, min(temp_min) AS coldest_recorded, "
        f"{avg('temp_mean', 'avg_temperature', 1)} FROM obs WHERE year BETWEEN 1996 AND 2000 GROUP BY country",
    ),
)
def country_extremes(t):
    return A.country_extremes(t.obs, 1996, 2000)


@query(
    "precip_annual",
    with_views(
        "obs",
        f"SELECT region, {total('precipitation', 'total_precip')}, {r('avg(precipitation) * 12', 4)} AS annual_avg "
        "FROM obs WHERE year = 1997 GROUP BY region",
    ),
)
def precip_annual(t):
    return rounded(rounded(A.precip_annual(t.obs, 1997), 2, "total_precip"), 4, "annual_avg")


@query(
    "anomaly_baseline",
    with_views(
        "obs baselines",
        f"""
  SELECT a.region, year, {r('m - baseline_temp', 2)} AS temp_anomaly
  FROM (SELECT region, year, avg(temp_mean) AS m FROM obs GROUP BY region, year) a JOIN baselines b ON a.region = b.region""",
    ),
)
def anomaly_baseline(t):
    return A.anomaly_by_baseline(t.obs, t.baselines)


@query(
    "monthly_summary",
    with_views(
        "obs",
        f"""
  SELECT station_id, country, month, year, region, {avg('temp_mean', 'avg_temperature')}, max(temp_max) AS max_temperature,
         min(temp_min) AS min_temperature, {total('precipitation', 'total_precipitation')},
         count(CASE WHEN precipitation > 0 THEN 1 END) AS rainy_days, {avg('sea_surface_temp', 'avg_sst')},
         {avg('ocean_salinity', 'avg_salinity')}, {N}
  FROM obs WHERE year >= 1996 AND temp_mean IS NOT NULL GROUP BY station_id, country, month, year, region""",
    ),
)
def monthly_summary(t):
    rows = A.monthly_summary(t.obs, 1996, "observation_date")
    return rounded(rounded(rows, 6, "avg_temperature", "avg_sst", "avg_salinity"), 2, "total_precipitation")


@query(
    "monthly_climate",
    with_views(
        "obs",
        f"SELECT region, year, month, {avg('temp_mean', 'avg_temp')}, {total('precipitation', 'total_precip')}, {N} FROM obs GROUP BY region, year, month",
    ),
)
def monthly_climate(t):
    return rounded(rounded(A.monthly_climate(t.obs), 6, "avg_temp"), 2, "total_precip")


@query(
    "scenario_agg",
    with_views(
        "obs",
        f"SELECT region, year, {avg('temp_mean', 'avg_temp')}, {total('precipitation', 'total_precip')}, {N} FROM obs GROUP BY region, year",
    ),
)
def scenario_agg(t):
    return rounded(rounded(A.scenario_agg(t.obs), 6, "avg_temp"), 2, "total_precip")


@query(
    "big_spenders",
    f"""
  SELECT o_custkey AS customer_id, c_name AS name, count(*) AS purchase_count, {r('sum(o_totalprice)', 2)} AS total_spent,
         {r('avg(o_totalprice)', 2)} AS avg_transaction_value
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1997-01-01'
  GROUP BY o_custkey, c_name HAVING sum(o_totalprice) > 5000 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 100""",
)
def big_spenders(t):
    sales = t.table("orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    sales = sales.select(F.col("o_custkey").alias("customer_id"), "o_totalprice")
    people = t.table("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    out = A.big_spenders(sales, people, "customer_id", "name", "o_totalprice")
    return rounded(out, 2, "total_spent", "avg_transaction_value")


@query(
    "revenue_cat",
    f"""
  SELECT r_name AS region, p_type AS category, {r('sum(l_extendedprice)', 2)} AS total_revenue,
         count(DISTINCT o_custkey) AS unique_customers
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey
  WHERE year(o_orderdate) = 1998 GROUP BY r_name, p_type""",
)
def revenue_cat(t):
    """Reduced to (customer, category) first: a count of those is the distinct count."""
    in_year = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    orders = t.table("orders").where(in_year).select("o_orderkey", "o_custkey")
    part = t.table("part").select("p_partkey", F.col("p_type").alias("category"))
    per_customer = joins.star(
        t.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"),
        [
            (orders, F.col("l_orderkey") == F.col("o_orderkey")),
            (part, F.col("l_partkey") == F.col("p_partkey")),
        ],
        ["o_custkey", "category"],
        [F.sum("l_extendedprice").alias("revenue")],
    )
    out = joins.star(
        per_customer,
        [
            (t.table("customer"), F.col("o_custkey") == F.col("c_custkey")),
            (t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")),
            (t.table("region"), F.col("n_regionkey") == F.col("r_regionkey")),
        ],
        [F.col("r_name").alias("region"), "category"],
        [F.sum("revenue").alias("total_revenue"), F.count("*").alias("unique_customers")],
    )
    return rounded(out, 2, "total_revenue").orderBy(F.desc("total_revenue"), "region", "category")


@query(
    "request_stats",
    f"SELECT count(*) AS total_requests, count(DISTINCT user_id) AS unique_users, {r('avg(value)', 2)} AS avg_time "
    "FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'",
)
def request_stats(t):
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return A.request_stats(t.table("events").where(F.col("ts") >= since), "user_id", "value")


@query(
    "skew_groupby",
    with_views(
        "obs",
        f"SELECT region, count(*) AS n, {total('temp_mean', 'total')}, {avg('temp_mean', 'mean')} FROM obs GROUP BY region",
    ),
)
def skew_groupby(t):
    out = salted_avg(t.obs, ["region"], "temp_mean", ["k1", "k2", "station_id"])
    return rounded(rounded(out, 2, "total"), 6, "mean")


@query(
    "topk_country",
    with_views(
        "obs",
        f"""
  SELECT country, region, {N}, {avg('temp_mean', 'avg_temp')},
         CAST(row_number() OVER (ORDER BY count(*) DESC, country, region) AS INT) AS position
  FROM obs GROUP BY country, region ORDER BY position LIMIT 10""",
    ),
)
def topk_country(t):
    return rounded(A.top_countries(t.fact, t.stations), 6, "avg_temp")
