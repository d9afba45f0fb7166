"""Joins of observations with stations, baselines and each other.

Unless an operator is about a strategy, it gives no hint: Spark broadcasts a
side below its threshold and shuffles otherwise, and AQE splits skewed keys.
Aggregates over a dimension's attributes are first reduced to one row per
station, so a hot station is collapsed before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.columns import month_cos, month_sin, region_code
from isobar.operators.filters import year_range
from isobar.operators.skew import BROADCAST_ROWS


def partial_sums(
    fact: DataFrame, keys: Sequence[str], values: Mapping[str, str | Column]
) -> DataFrame:
    """`<name>_sum` and `<name>_n` of each value and `rows`, per key."""
    aggs = [F.count("*").alias("rows")]
    for name, value in values.items():
        aggs += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return fact.groupBy(*keys).agg(*aggs)


def merged_avg(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def country_year_sst(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean sea-surface temperature by country and year, active stations only."""
    part = partial_sums(fact, ["station_id", "year"], {"sst": "sea_surface_temp"})
    dim = stations.where("is_active").select("station_id", "country")
    return (
        part.join(dim, "station_id")
        .groupBy("country", "year")
        .agg(merged_avg("sst").alias("avg_sst"))
    )


def country_region_broadcast(
    fact: DataFrame, stations: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Count and mean temperature by country and region, map-side join of per-station sums.

    The stations are counted first; beyond the bound the shuffle form runs.
    """
    dim = stations.select("station_id", "country", "region")
    if dim.count() > max_rows:
        return country_region_shuffle(fact, stations)
    part = partial_sums(fact, ["station_id"], {"temp": "temp_mean"})
    return (
        part.join(F.broadcast(dim), "station_id")
        .groupBy("country", "region")
        .agg(F.sum("rows").alias("n"), merged_avg("temp").alias("avg_temp"))
    )


def country_region_shuffle(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """The same result by sort-merge join over per-station sums."""
    part = partial_sums(fact, ["station_id"], {"temp": "temp_mean"})
    dim = stations.select("station_id", "country", "region").hint("merge")
    return (
        part.join(dim, "station_id")
        .groupBy("country", "region")
        .agg(F.sum("rows").alias("n"), merged_avg("temp").alias("avg_temp"))
    )


def country_region_bucketed(
    fact: DataFrame, stations: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """The same result over co-bucketed tables: neither side is shuffled for the join.

    `hot` holds the rows of stations too large for one bucket; they join by
    per-station sums, of which there are few.
    """
    dim = stations.select("station_id", "country", "region")
    values = {"temp": "temp_mean"}
    part = partial_sums(fact, ["station_id"], values).join(dim.hint("merge"), "station_id")
    if hot is not None:
        part = part.unionByName(partial_sums(hot, ["station_id"], values).join(dim, "station_id"))
    return part.groupBy("country", "region").agg(
        F.sum("rows").alias("n"), merged_avg("temp").alias("avg_temp")
    )


def enrich(obs: DataFrame, stations: DataFrame, baselines: DataFrame) -> DataFrame:
    """Adds station attributes, the anomaly against the region's baseline and the season."""
    attrs = ["station_name", "country", "region", "latitude", "longitude"]
    return (
        obs.drop(*attrs)
        .join(stations.select("station_id", *attrs), "station_id")
        .join(baselines, "region", "left")
        .withColumn("temp_anomaly", F.col("temp_mean") - F.col("baseline_temp"))
        .withColumn("month_sin", month_sin("month"))
        .withColumn("month_cos", month_cos("month"))
    )


def _product(a: str, b: str) -> Column:
    """Number of pairs, as decimal(38,0): two counts of some billions exceed a BIGINT."""
    return (F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")).cast("decimal(38,0)")


def rain_vs_salinity(
    climate: DataFrame, ocean: DataFrame, min_rain: float = 100.0, max_salinity: float = 33.0
) -> DataFrame:
    """Days on which a region had heavy rain and fresh surface water.

    (date, region) repeats on both sides. Each side is reduced to one row per
    key before the join, so the pairs of a key are counted, not produced:
    `pairs` is how many rows the plain join would have, the means are theirs.
    """
    c = (
        climate.where(F.col("rainfall") > min_rain)
        .groupBy("date", "region")
        .agg(
            F.count("*").alias("c_n"),
            F.avg("rainfall").alias("avg_rainfall"),
            F.max("rainfall").alias("max_rainfall"),
        )
    )
    o = (
        ocean.where(F.col("salinity") < max_salinity)
        .groupBy("date", "region")
        .agg(
            F.count("*").alias("o_n"),
            F.avg("salinity").alias("avg_salinity"),
            F.min("salinity").alias("min_salinity"),
        )
    )
    return (
        c.join(o, ["date", "region"])
        .select(
            "region",
            "date",
            _product("c_n", "o_n").alias("pairs"),
            "avg_rainfall",
            "max_rainfall",
            "avg_salinity",
            "min_salinity",
        )
        .orderBy(F.desc("max_rainfall"), "date", "region")
    )


def fact_by_fact(left: DataFrame, right: DataFrame, from_year: int = 2020, date: str | None = None) -> DataFrame:
    """Two fact tables joined on station only, summed up per station.

    All pairs of a station would be the product of its row counts. Counts and
    sums over those pairs follow from each side's own sums, so every side is
    aggregated once and one row per station is joined. Where the year follows from
    a date, `date` names it and the bound reaches the files.
    """
    a = year_range(left, from_year, date=date)
    a = partial_sums(a, ["station_id"], {"temp": "temp_mean"})
    b = partial_sums(right, ["station_id"], {"rain": "precipitation"})
    a = a.withColumnRenamed("rows", "a_rows")
    b = b.withColumnRenamed("rows", "b_rows")
    return a.join(b, "station_id").select(
        "station_id",
        _product("a_rows", "b_rows").alias("pairs"),
        (F.col("temp_sum") * F.col("b_rows")).alias("sum_temp"),
        (F.col("rain_sum") * F.col("a_rows")).alias("sum_precip"),
        F.try_divide("temp_sum", "temp_n").alias("avg_temp"),
        F.try_divide("rain_sum", "rain_n").alias("avg_precip"),
    )


def with_station(fact: DataFrame, stations: DataFrame, regions: DataFrame) -> DataFrame:
    """Observation → station → region: the full record of one observation."""
    attrs = ["station_name", "country", "region", "latitude", "longitude"]
    return fact.join(stations.select("station_id", *attrs), "station_id").join(
        regions.select(F.col("name").alias("region"), F.col("code").alias("region_code")), "region"
    )


def station_counts(stations: DataFrame, fact: DataFrame) -> DataFrame:
    """Stations with their number of observations; zero where there are none."""
    n = fact.groupBy("station_id").agg(F.count("*").alias("n"))
    return (
        stations.join(n, "station_id", "left")
        .withColumn("observation_count", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


def split_known(fact: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations of known stations, orphans)."""
    keys = stations.select("station_id")
    return fact.join(keys, "station_id", "left_semi"), fact.join(keys, "station_id", "left_anti")


def orphan_counts(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows kept and skipped by the station check, in one pass over the fact."""
    n = fact.groupBy("station_id").agg(F.count("*").alias("n"))
    known = stations.select("station_id", F.lit(True).alias("known"))
    flag = F.when(F.col("known"), F.lit("kept")).otherwise(F.lit("skipped"))
    return (
        n.join(known, "station_id", "left")
        .groupBy(flag.alias("kind"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("stations"))
    )


def flag_existing(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds `exists`: whether the key is already in the target (its keys are unique)."""
    there = target.select(*keys, F.lit(True).alias("_there"))
    return (
        incoming.join(there, list(keys), "left")
        .withColumn("exists", F.col("_there").isNotNull())
        .drop("_there")
    )


def match_region(df: DataFrame, regions: DataFrame, text: str = "region_text") -> DataFrame:
    """Region code by name in any case, else by the code made from the text."""
    by_name = regions.groupBy(F.lower("name").alias("_name")).agg(F.min("code").alias("_by_name"))
    by_code = regions.groupBy(F.col("code").alias("_code")).agg(F.min("code").alias("_by_code"))
    # Neither has more rows than the regions themselves.
    if regions.count() <= BROADCAST_ROWS:
        by_name, by_code = F.broadcast(by_name), F.broadcast(by_code)
    return (
        df.join(by_name, F.lower(text) == F.col("_name"), "left")
        .join(by_code, region_code(text) == F.col("_code"), "left")
        .withColumn("region_code", F.coalesce("_by_name", "_by_code"))
        .drop("_name", "_code", "_by_name", "_by_code")
    )


def star(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, Column | str]],
    keys: Sequence[Column | str],
    aggs: Sequence[Column],
) -> DataFrame:
    """A fact joined with one dimension after the other, then grouped."""
    for dim, on in dims:
        fact = fact.join(dim, on)
    return fact.groupBy(*keys).agg(*aggs)
