"""The climate model over an order/supplier star schema, in Spark and in SQL.

The same definitions are given twice, once as frames and once as the SQL text
that an independent engine runs for comparison.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isobar.functions.columns import region_code
from isobar.operators.skew import BROADCAST_ROWS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Schemas as the files state them; each file is asked once per process.
_SCHEMAS: dict[str, StructType] = {}

# Together these tell any two observations apart.
TIE = ["k1", "k2", "k3"]
DAY_ORDER = ["station_id", *TIE]

STATION_SQL = """
  SELECT s_suppkey AS station_id, s_name AS station_name, n_name AS country, r_name AS region,
         CAST(s_suppkey % 72 AS DOUBLE) - 35 AS latitude,
         CAST(s_suppkey % 68 AS DOUBLE) - 17 AS longitude,
         CASE WHEN s_acctbal >= 0 THEN s_acctbal / 4 END AS elevation,
         s_suppkey % 3 = 0 AS is_coastal, s_acctbal > 0 AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
FACT_SQL = """
  SELECT l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS station_id,
         CAST(l_shipdate AS DATE) AS observation_date,
         CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
         l_quantity + 100 * l_tax AS temp_max, l_quantity - 100 * l_discount AS temp_min,
         l_quantity AS temp_mean,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice / 1000 END AS precipitation,
         40 + 500 * l_tax AS humidity,
         CASE WHEN l_suppkey % 3 = 0 THEN 18 + l_quantity / 5 END AS sea_surface_temp,
         CASE WHEN l_suppkey % 3 = 0 THEN 33 + 40 * l_discount END AS ocean_salinity,
         CASE l_returnflag WHEN 'A' THEN 'excellent' WHEN 'N' THEN 'good'
              ELSE CASE WHEN l_linestatus = 'F' THEN 'fair' ELSE 'poor' END END AS data_quality
  FROM lineitem
"""
# Readings as delivered: some dates missing, some values out of range.
RAW_SQL = """
  SELECT * REPLACE (
           CASE WHEN k2 = 7 THEN NULL ELSE observation_date END AS observation_date,
           (temp_mean - 25) * 3 AS temp_mean,
           (humidity - 40) * 3 - 10 AS humidity)
  FROM fact
"""
REGION_SQL = """
  SELECT r_name AS name, upper(replace(substr(r_name, 1, 10), ' ', '_')) AS code,
         'Region ' || r_name AS description
  FROM region
"""
# One region has no baseline.
BASELINE_SQL = """
  SELECT r_name AS region, CAST(20 + 2 * r_regionkey AS DOUBLE) AS baseline_temp
  FROM region WHERE r_regionkey <> 4
"""
RUN_SQL = """
  SELECT event_id AS run_id, 'user-' || user_id AS scenario,
         CASE user_id % 5 WHEN 0 THEN 'joins' WHEN 1 THEN 'aggregation'
              WHEN 2 THEN 'complex_types' WHEN 3 THEN 'io' ELSE 'partitioning' END AS scenario_type,
         value / 20 AS seconds,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         ts AS executed_at
  FROM events
"""
METRIC_SQL = """
  SELECT run_id, 'query time' AS name, seconds * 1000 AS value, 'ms' AS unit,
         CAST(2000 AS DOUBLE) AS target, 'lower' AS direction FROM runs
  UNION ALL
  SELECT run_id, 'data read', seconds * 100, 'MB/s', CAST(300 AS DOUBLE), 'higher' FROM runs
"""
_CTES = {
    "stations": STATION_SQL,
    "fact": FACT_SQL,
    "obs": "SELECT f.*, s.station_name, s.country, s.region, s.latitude, s.longitude, "
    "s.elevation, s.is_coastal, s.is_active FROM fact f JOIN stations s USING (station_id)",
    "raw": RAW_SQL,
    "regions": REGION_SQL,
    "baselines": BASELINE_SQL,
    "runs": RUN_SQL,
    "metrics": METRIC_SQL,
}
_NEEDS = {"obs": ["stations", "fact"], "raw": ["fact"], "metrics": ["runs"]}


def with_views(names: str, body: str) -> str:
    """The body after WITH clauses for the named frames and what they need."""
    wanted: list[str] = []
    for name in names.split():
        for n in [*_NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    ctes = ",\n".join(f"{n} AS ({_CTES[n]})" for n in wanted)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def r(expr: str, places: int) -> str:
    """The SQL form of stable_round."""
    return (
        f"CAST(round(CAST({expr} AS DECIMAL(38,{places + 4})), {places}) AS DOUBLE)"
    )


class Inputs:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        known = _SCHEMAS.get(path)
        if known is None:
            known = _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(known).parquet(path)

    def _with_place(self, df: DataFrame) -> DataFrame:
        """Nation and region of a frame with supplier columns.

        Every join has a plain file on its right side: Spark knows its size.
        The size of a joined dimension would be guessed as the product of its
        parts, and the fact broadcast instead.
        """
        return df.join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @staticmethod
    def _attributes() -> list[Column]:
        key = F.col("s_suppkey")
        return [
            F.col("s_name").alias("station_name"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            ((key % 72).cast("double") - 35).alias("latitude"),
            ((key % 68).cast("double") - 17).alias("longitude"),
            F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 4).alias("elevation"),
            (key % 3 == 0).alias("is_coastal"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        ]

    @cached_property
    def plain_stations(self) -> DataFrame:
        return self._with_place(self.table("supplier")).select(
            F.col("s_suppkey").alias("station_id"), *self._attributes()
        )

    @cached_property
    def stations(self) -> DataFrame:
        """Stations, to be broadcast if their file says they are few."""
        few = self.table("supplier").count() <= BROADCAST_ROWS
        return F.broadcast(self.plain_stations) if few else self.plain_stations

    @cached_property
    def fact(self) -> DataFrame:
        q, coastal = F.col("l_quantity"), F.col("l_suppkey") % 3 == 0
        day = F.col("l_shipdate").cast("date")
        quality = (
            F.when(F.col("l_returnflag") == "A", "excellent")
            .when(F.col("l_returnflag") == "N", "good")
            .when(F.col("l_linestatus") == "F", "fair")
            .otherwise("poor")
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("k1"),
            F.col("l_linenumber").alias("k2"),
            F.col("l_partkey").alias("k3"),
            F.col("l_suppkey").alias("station_id"),
            day.alias("observation_date"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            (q + 100 * F.col("l_tax")).alias("temp_max"),
            (q - 100 * F.col("l_discount")).alias("temp_min"),
            q.alias("temp_mean"),
            F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice") / 1000).alias(
                "precipitation"
            ),
            (40 + 500 * F.col("l_tax")).alias("humidity"),
            F.when(coastal, 18 + q / 5).alias("sea_surface_temp"),
            F.when(coastal, 33 + 40 * F.col("l_discount")).alias("ocean_salinity"),
            quality.alias("data_quality"),
        )

    @cached_property
    def obs(self) -> DataFrame:
        """Observations with their station's attributes."""
        rows = self.fact.join(
            self.table("supplier"), F.col("station_id") == F.col("s_suppkey")
        )
        return self._with_place(rows).select(*self.fact.columns, *self._attributes())

    @cached_property
    def raw(self) -> DataFrame:
        return self.fact.withColumns(
            {
                "observation_date": F.when(F.col("k2") != 7, F.col("observation_date")),
                "temp_mean": (F.col("temp_mean") - 25) * 3,
                "humidity": (F.col("humidity") - 40) * 3 - 10,
            }
        )

    @cached_property
    def raw_obs(self) -> DataFrame:
        """Raw readings with their region, as delivered files carry it."""
        rows = self.raw.join(self.table("supplier"), F.col("station_id") == F.col("s_suppkey"))
        return self._with_place(rows).select(*self.raw.columns, F.col("r_name").alias("region"))

    @cached_property
    def regions(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_name").alias("name"),
            region_code("r_name").alias("code"),
            F.concat(F.lit("Region "), "r_name").alias("description"),
        )

    @cached_property
    def baselines(self) -> DataFrame:
        return (
            self.table("region")
            .where(F.col("r_regionkey") != 4)
            .select(
                F.col("r_name").alias("region"),
                (20 + 2 * F.col("r_regionkey")).cast("double").alias("baseline_temp"),
            )
        )

    @cached_property
    def runs(self) -> DataFrame:
        kind = F.col("user_id") % 5
        return self.table("events").select(
            F.col("event_id").alias("run_id"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("scenario"),
            F.when(kind == 0, "joins")
            .when(kind == 1, "aggregation")
            .when(kind == 2, "complex_types")
            .when(kind == 3, "io")
            .otherwise("partitioning")
            .alias("scenario_type"),
            (F.col("value") / 20).alias("seconds"),
            F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
            F.col("ts").alias("executed_at"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """Two measured values per run."""

        def metric(name, value, unit, target, direction):
            return F.struct(
                F.lit(name).alias("name"),
                value.alias("value"),
                F.lit(unit).alias("unit"),
                F.lit(float(target)).alias("target"),
                F.lit(direction).alias("direction"),
            )

        both = F.array(
            metric("query time", F.col("seconds") * 1000, "ms", 2000, "lower"),
            metric("data read", F.col("seconds") * 100, "MB/s", 300, "higher"),
        )
        return self.runs.select("run_id", F.inline(both))
