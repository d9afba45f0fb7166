"""Window measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators import joins, windows
from isobar.plans.adapter import TIE, r, with_views
from isobar.plans.catalog.base import query

ANOMALY_SQL = f"""
  SELECT station_id, observation_date, k1, k2, k3, sea_surface_temp,
         {{}} AS sst_anomaly
  FROM (SELECT *, sum(CAST(sea_surface_temp AS DECIMAL(18,5))) OVER w AS s, count(*) OVER w AS n
        FROM fact WHERE sea_surface_temp IS NOT NULL AND year >= 1996
        WINDOW w AS (PARTITION BY station_id ORDER BY observation_date, k1, k2, k3
                     ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING))"""
ANOMALY_SQL = ANOMALY_SQL.format(r("sea_surface_temp - CAST(s AS DOUBLE) / n", 2))
ANOMALY_COLUMNS = ["station_id", "observation_date", "k1", "k2", "k3", "sea_surface_temp", "sst_anomaly"]


@query(
    "sst_anomaly",
    with_views(
        "fact",
        f"{ANOMALY_SQL} ORDER BY sst_anomaly DESC NULLS LAST, station_id, observation_date, k1, k2, k3 LIMIT 100",
    ),
)
def sst_anomaly(t):
    return windows.top_sst_anomalies(t.fact, TIE, 100, from_year=1996).select(*ANOMALY_COLUMNS)


@query("sst_anomaly_rows", with_views("fact", ANOMALY_SQL))
def sst_anomaly_rows(t):
    """The anomaly of every coastal row, without the report's limit."""
    return windows.sst_anomaly(t.fact, TIE, 1996, date="observation_date").select(*ANOMALY_COLUMNS)


@query(
    "rolling_30d",
    with_views(
        "fact",
        f"""
  SELECT station_id, observation_date, {r('sum(day) OVER (PARTITION BY station_id ORDER BY observation_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)', 2)} AS rolling_precip
  FROM (SELECT station_id, observation_date, sum(CAST(precipitation AS DECIMAL(18,5))) AS day FROM fact GROUP BY station_id, observation_date)""",
    ),
)
def rolling_30d(t):
    return windows.rolling_precip(t.fact)


@query(
    "yoy",
    with_views(
        "obs",
        f"""WITH m AS (SELECT region, month, year, avg(temp_mean) AS a FROM obs GROUP BY region, month, year)
  SELECT m.region, m.month, m.year, {r('m.a', 2)} AS avg_temp, {r('m.a - p.a', 2)} AS change
  FROM m LEFT JOIN m p ON m.region = p.region AND m.month = p.month AND p.year = m.year - 1""",
    ),
)
def yoy(t):
    return windows.year_over_year(t.obs)


@query(
    "latest_per_key",
    with_views(
        "fact",
        """
  SELECT station_id, observation_date, k1, k2, k3, temp_mean, precipitation FROM fact
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY observation_date DESC, k1, k2, k3) = 1""",
    ),
)
def latest_per_key(t):
    order = [F.desc("observation_date"), *[F.col(c) for c in TIE]]
    rows = windows.latest_per_key(t.fact, ["station_id"], order)
    return rows.select("station_id", "observation_date", *TIE, "temp_mean", "precipitation")


@query(
    "recent_n",
    with_views(
        "fact",
        """
  SELECT station_id, observation_date, k1, k2, k3, temp_mean,
         CAST(row_number() OVER (PARTITION BY station_id ORDER BY observation_date DESC, k1, k2, k3) AS INT) AS recency
  FROM fact QUALIFY recency <= 10""",
    ),
)
def recent_n(t):
    order = [F.desc("observation_date"), *[F.col(c) for c in TIE]]
    rows = windows.recent_n(t.fact, ["station_id"], order, 10)
    return rows.select("station_id", "observation_date", *TIE, "temp_mean", "recency")


@query(
    "top_rank",
    with_views(
        "obs",
        """
  SELECT country, n, CAST(rank() OVER (ORDER BY n DESC) AS INT) AS rank,
         CAST(row_number() OVER (ORDER BY n DESC, country) AS INT) AS position
  FROM (SELECT country, count(*) AS n FROM obs GROUP BY country)""",
    ),
)
def top_rank(t):
    part = joins.partial_sums(t.fact, ["station_id"], {})
    n = (
        part.join(t.stations.select("station_id", "country"), "station_id")
        .groupBy("country")
        .agg(F.sum("rows").alias("n"))
    )
    return windows.ranked(n, [F.desc("n")], [F.asc("country")])
