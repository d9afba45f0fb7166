"""Distributed generators for stations, observations, climate and ocean rows.

Every value comes from a digest of the row's key, a seed and the number of the
draw: the rows do not depend on partitioning, and any row can be made anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.columns import uniform

# Size presets, countries, coordinate boxes and base temperatures.
SIZE_PRESETS = {
    "small": {"stations": 100, "per_station": 50, "climate": 1_000, "ocean": 1_000},
    "medium": {"stations": 500, "per_station": 150, "climate": 10_000, "ocean": 10_000},
    "large": {"stations": 2_500, "per_station": 380, "climate": 25_000, "ocean": 25_000},
    "xlarge": {"stations": 5_000, "per_station": 950, "climate": 100_000, "ocean": 100_000},
}
# region: (countries, latitude box, longitude box, base temperature)
REGION_PROFILES = {
    "East": ("KE TZ UG ET SO RW BI DJ ER", (-10, 15), (30, 51), 24),
    "West": ("NG GH SN CI ML BF NE GN BJ TG", (5, 20), (-17, 15), 27),
    "North": ("EG MA DZ TN LY SD MR", (15, 37), (-17, 35), 22),
    "South": ("ZA NA BW ZW MZ ZM AO MW LS SZ", (-35, -10), (10, 40), 18),
    "Central": ("CD GA CM CF CG TD GQ ST", (-5, 10), (8, 30), 28),
}
WET_REGIONS = ["Central", "East"]
COASTAL_SHARE = 0.3
ACTIVE_SHARE = 0.95
OBSERVED_DAYS = ("1980-01-01", "2024-12-31")
RECENT_DAYS = ("2020-01-01", "2024-12-31")

# Which draw of a row stands for what.
STATION_DRAWS = ["region", "country", "lat", "lon", "elevation", "coastal", "active"]
OBSERVATION_DRAWS = ["day", "mean", "up", "down", "rain", "humidity", "sst", "salinity"]
CLIMATE_SPANS = {"temperature": (15, 45), "rainfall": (0, 200), "humidity": (20, 95)}
OCEAN_SPANS = {"sea_surface_temp": (10, 30), "ph_level": (7.8, 8.4), "salinity": (32, 38)}


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id"))


def _between(u: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return low + u * (high - low)


def _profile(region: Column) -> dict[str, Column]:
    """The constants of the row's region as columns."""

    def pick(value) -> Column:
        out = F.lit(None)
        for name, p in REGION_PROFILES.items():
            out = F.when(region == name, value(p)).otherwise(out)
        return out

    return {
        "countries": pick(lambda p: F.array(*[F.lit(c) for c in p[0].split()])),
        "lat_low": pick(lambda p: F.lit(float(p[1][0]))),
        "lat_high": pick(lambda p: F.lit(float(p[1][1]))),
        "lon_low": pick(lambda p: F.lit(float(p[2][0]))),
        "lon_high": pick(lambda p: F.lit(float(p[2][1]))),
        "base": pick(lambda p: F.lit(float(p[3]))),
    }


def _choice(items: Column, u: Column) -> Column:
    return F.element_at(items, F.floor(u * F.size(items)).cast("int") + 1)


def _any_region(u: Column) -> Column:
    return _choice(F.array(*[F.lit(r) for r in REGION_PROFILES]), u)


def _days(span: tuple[str, str]) -> int:
    a, b = (dt.date.fromisoformat(s) for s in span)
    return (b - a).days + 1


def gen_stations(source: DataFrame, seed: int = 7, id_col: str = "id") -> DataFrame:
    """One station per row of `source`, whose id column numbers them."""

    def u(draw):
        return uniform("_i", seed, STATION_DRAWS.index(draw))

    base = source.select(F.col(id_col).cast("long").alias("_i")).withColumn(
        "region", _any_region(u("region"))
    )
    p = _profile(F.col("region"))
    base = base.withColumn("country", _choice(p["countries"], u("country"))).withColumn(
        "station_id",
        F.concat_ws(
            "-",
            "country",
            F.upper(F.substring("region", 1, 3)),
            # Five digits at least; longer numbers are kept whole.
            F.format_string("%05d", F.col("_i")),
        ),
    )
    return base.select(
        "station_id",
        F.concat(F.lit("Station "), "station_id").alias("station_name"),
        "country",
        "region",
        F.round(_between(u("lat"), p["lat_low"], p["lat_high"]), 4).alias("latitude"),
        F.round(_between(u("lon"), p["lon_low"], p["lon_high"]), 4).alias("longitude"),
        F.round(_between(u("elevation"), 0, 3000), 1).alias("elevation"),
        (u("coastal") < COASTAL_SHARE).alias("is_coastal"),
        (u("active") < ACTIVE_SHARE).alias("is_active"),
    )


def gen_obs(stations: DataFrame, per_station: int, seed: int = 7) -> DataFrame:
    """`per_station` observations on distinct days for every station.

    The span is cut into `per_station` runs of days and one day is drawn from
    each: distinct by construction, with no per-station list, sort or shuffle.
    """
    total = _days(OBSERVED_DAYS)
    if not 0 < per_station <= total:
        raise ValueError(f"per_station must lie in 1..{total}")
    k = F.lit(per_station)
    rows = stations.select("station_id", "region", "is_coastal").withColumn(
        "_k", F.explode(F.sequence(F.lit(0), F.lit(per_station - 1)))
    )
    rows = rows.withColumn("_key", F.concat_ws("#", "station_id", "_k"))

    def u(draw):
        return uniform("_key", seed, OBSERVATION_DRAWS.index(draw))

    low = F.floor(F.col("_k") * F.lit(total) / k)
    high = F.floor((F.col("_k") + 1) * F.lit(total) / k)
    day = (low + F.floor(u("day") * (high - low))).cast("int")
    date = F.date_add(F.lit(OBSERVED_DAYS[0]).cast("date"), day)
    mean = _profile(F.col("region"))["base"] + _between(u("mean"), -10, 15)
    wet = F.when(F.col("region").isin(WET_REGIONS), F.lit(100.0)).otherwise(F.lit(30.0))
    rain = F.least(-(wet / 3.0) * F.log(F.lit(1.0) - u("rain")), F.lit(500.0))
    rows = rows.withColumn("observation_date", date).withColumn("_mean", mean)

    def coastal(c: Column) -> Column:
        return F.when(F.col("is_coastal"), F.round(c, 1))

    return rows.select(
        "station_id",
        "observation_date",
        F.year("observation_date").alias("year"),
        F.month("observation_date").alias("month"),
        F.round(F.col("_mean") + _between(u("up"), 2, 8), 1).alias("temp_max"),
        F.round(F.col("_mean") - _between(u("down"), 2, 8), 1).alias("temp_min"),
        F.round("_mean", 1).alias("temp_mean"),
        F.round(rain, 1).alias("precipitation"),
        F.round(_between(u("humidity"), 40, 95), 1).alias("humidity"),
        coastal(_between(u("sst"), 18, 28)).alias("sea_surface_temp"),
        coastal(_between(u("salinity"), 33, 37)).alias("ocean_salinity"),
        "region",
    )


def _dated(source: DataFrame, seed: int, id_col: str, measures: dict) -> DataFrame:
    draws = ["day", "region", *measures]

    def u(draw):
        return uniform(id_col, seed, draws.index(draw))

    day = F.floor(u("day") * F.lit(_days(RECENT_DAYS))).cast("int")
    return source.select(
        F.date_add(F.lit(RECENT_DAYS[0]).cast("date"), day).alias("date"),
        _any_region(u("region")).alias("region"),
        *[F.round(_between(u(n), a, b), 2).alias(n) for n, (a, b) in measures.items()],
    )


def gen_climate(source: DataFrame, seed: int = 7, id_col: str = "id") -> DataFrame:
    return _dated(source, seed, id_col, CLIMATE_SPANS)


def gen_ocean(source: DataFrame, seed: int = 8, id_col: str = "id") -> DataFrame:
    return _dated(source, seed, id_col, OCEAN_SPANS)
