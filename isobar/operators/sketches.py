"""Medians and distinct stations over any range of years, from stored sketches.

A table holds, per year and region, a quantile sketch of temperatures and a
distinct-count sketch of stations. Both merge: a range of years costs one row per year
and region, whatever the number of readings. A year that is loaded again replaces its
own sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.filters import year_range
from isobar.sources.tables import overwrite_partitions, write_warehouse

#: Size of a quantile sketch and the rank error it keeps to; the same for distinct counts.
QUANTILE_K = 1000
RANK_ERROR = 0.01
DISTINCT_LG_K = 14
COUNT_ERROR = 0.03


def sketch(obs: DataFrame, value: str = "temp_mean", key: str = "station_id") -> DataFrame:
    """One row per region and year, combined before the shuffle; NaN readings don't count."""
    known = F.when(~F.isnan(value), F.col(value))
    return obs.groupBy("region", "year").agg(
        F.count("*").alias("rows"),
        F.kll_sketch_agg_double(known, QUANTILE_K).alias("values"),
        F.hll_sketch_agg(key, DISTINCT_LG_K).alias("keys"),
    )


def create(obs: DataFrame, table: str, path: str | None = None, **columns) -> DataFrame:
    return write_warehouse(sketch(obs, **columns), table, ("year",), None, path=path, fmt="parquet")


def refresh(obs: DataFrame, table: str, **columns) -> None:
    """Sketches of the years that the rows lie in; the rows are all of those years."""
    overwrite_partitions(sketch(obs, **columns), table)


def over_years(spark: SparkSession, table: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Per region: rows, median (NULL without readings) and distinct keys of a range of years."""
    held = year_range(spark.table(table), first, last)
    merged = held.groupBy("region").agg(
        F.sum("rows").alias("rows"),
        F.kll_merge_agg_double("values").alias("values"),
        F.hll_union_agg("keys").alias("keys"),
    )
    some = F.kll_sketch_get_n_double("values") > 0
    return merged.select(
        "region",
        "rows",
        F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(0.5))).alias("median"),
        F.hll_sketch_estimate("keys").alias("keys"),
    )


def median_holds(below: Column, upto: Column, n: Column) -> Column:
    """Whether a value with so many readings below it, and up to it, is a median within RANK_ERROR."""
    return (below / n <= 0.5 + RANK_ERROR) & (upto / n >= 0.5 - RANK_ERROR)
