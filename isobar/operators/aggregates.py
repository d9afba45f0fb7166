"""Grouped summaries. Figures are raw unless the report itself rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.functions.columns import month_name, region_key, safe_corr, stable_round, with_suffix
from isobar.operators.filters import year_range
from isobar.operators.joins import merged_avg, partial_sums, station_counts
from isobar.operators.skew import GROUP_ROWS, measured, running_total, split_hot
from isobar.session import shared_dir

# Pivot columns, report factors and the size estimate per row.
PIVOT_REGIONS = ["east", "west", "north", "south", "central"]
BASELINE_FACTOR = 1.1
PREDICTED_FACTOR = 0.98
MB_PER_ROW = 0.0005


def _n() -> Column:
    return F.count("*").alias("observation_count")


def _avg(c: str, name: str, places: int | None = None) -> Column:
    a = F.avg(c)
    return (a if places is None else stable_round(a, places)).alias(name)


def _everything() -> Window:
    """A window over a whole frame; only for aggregates of a few rows."""
    return Window.partitionBy(F.lit(1))


def count_all(obs: DataFrame) -> DataFrame:
    return obs.agg(F.count("*").alias("n"))


def region_avg(obs: DataFrame) -> DataFrame:
    return obs.groupBy("region").agg(
        _n(), _avg("temp_mean", "avg_temp"), _avg("precipitation", "avg_precip")
    )


def region_month(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("region", "month")
        .agg(_avg("temp_mean", "avg_temp"), F.sum("precipitation").alias("total_precip"))
        .orderBy("region", "month")
    )


def year_month_region(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("year", "month", "region")
        .agg(
            _avg("temp_mean", "avg_temp"),
            _avg("humidity", "avg_humidity"),
            F.sum("precipitation").alias("total_precip"),
        )
        .orderBy("year", "month", "region")
    )


def year_trend(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("year")
        .agg(
            _avg("temp_mean", "avg_temp"),
            F.max("temp_max").alias("max_temp"),
            F.min("temp_min").alias("min_temp"),
        )
        .orderBy("year")
    )


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, max_group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Median by counting: rows become one count per (keys, value) before any
    group is looked at, so a group costs its distinct readings, not its rows.

    The counts are computed once. A group with very many readings is summed up
    in pieces.
    """
    shared_dir(df.sparkSession)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_c"))
        .checkpoint()
    )
    cold, hot = split_hot(counts, keys, max_group_rows)
    w = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = cold.withColumn("_upto", F.sum("_c").over(w))
    if hot is not None:
        upto = upto.unionByName(running_total(hot, keys, [F.col("_v")], F.col("_c"), "_upto"))
    totals = counts.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_c").alias("_n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    ranked = upto.join(measured(totals), same)
    before = F.col("_upto") - F.col("_c")

    def at(rank: Column) -> Column:
        return F.max(F.when((before < rank) & (rank <= F.col("_upto")), F.col("_v")))

    low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"))


def region_stats(obs: DataFrame, exact: bool = False) -> DataFrame:
    """Spread of the daily range, humidity-rain correlation, median and extremes.

    One pass with a bounded sketch for the median; `exact` counts it instead.
    """
    daily = F.col("temp_max") - F.col("temp_min")
    out = obs.groupBy("region").agg(
        F.stddev_pop(daily).alias("range_stddev"),
        safe_corr("humidity", "precipitation").alias("humidity_precip_corr"),
        F.percentile_approx("temp_mean", 0.5, 10_000).alias("median_temp"),
        F.min("temp_min").alias("min_temp"),
        F.max("temp_max").alias("max_temp"),
    )
    if not exact:
        return out
    medians = exact_median(obs, ["region"], "temp_mean").withColumnRenamed("median", "median_temp")
    return out.drop("median_temp").join(medians, "region", "left")


def coverage(fact: DataFrame, stations: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct stations, years, regions and countries that have observations.

    Rows are first reduced to (station, year); only those meet the stations.
    """
    seen = fact.select("station_id", "year").distinct()
    dim = stations.select("station_id", "region", "country")
    rows = seen.join(dim, "station_id")
    count = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(
        count("station_id").alias("stations"),
        count("year").alias("years"),
        count("region").alias("regions"),
        count("country").alias("countries"),
    )


def region_summary(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct stations, rows, means and rain per region.

    One row per station first: its count is the distinct count, with no
    expansion of the fact for DISTINCT.
    """
    values = {"temp": "temp_mean", "hum": "humidity", "rain": "precipitation"}
    part = partial_sums(fact, ["station_id"], values)
    return (
        part.join(stations.select("station_id", "region"), "station_id")
        .groupBy("region")
        .agg(
            F.count("*").alias("station_count"),
            F.sum("rows").alias("observation_count"),
            merged_avg("temp").alias("avg_temp"),
            merged_avg("hum").alias("avg_humidity"),
            F.sum("rain_sum").alias("total_precip"),
        )
        .orderBy("region")
    )


def region_year_detail(obs: DataFrame) -> DataFrame:
    return obs.groupBy("region", "year").agg(
        _n(),
        _avg("temp_mean", "avg_temp"),
        F.min("temp_mean").alias("min_temp"),
        F.max("temp_mean").alias("max_temp"),
        F.stddev_samp("temp_mean").alias("temp_stddev"),
    )


def country_region(obs: DataFrame) -> DataFrame:
    return obs.groupBy("country", "region").agg(_n(), _avg("temp_mean", "avg_temp"))


def temp_trends(obs: DataFrame, first: int = 2015, last: int = 2024) -> DataFrame:
    return (
        year_range(obs, first, last)
        .groupBy("year", "region")
        .agg(
            _avg("temp_max", "avg_temp_max", 2),
            _avg("temp_min", "avg_temp_min", 2),
            _avg("temp_mean", "avg_temp_mean", 2),
        )
        .orderBy("year", "region")
    )


def precipitation_by_region(obs: DataFrame, year: int) -> DataFrame:
    return (
        year_range(obs, year, year)
        .where(F.col("precipitation").isNotNull())
        .groupBy("region")
        .agg(
            stable_round(F.sum("precipitation"), 2).alias("total_precipitation"),
            _avg("precipitation", "avg_precipitation", 2),
            _n(),
        )
        .withColumn("year", F.lit(year))
    )


def ocean_conditions(fact: DataFrame, year: int) -> DataFrame:
    """By month: mean surface temperature and salinity, distinct stations.

    Reduced to (month, station) first, which turns the distinct count into a count.
    """
    values = {"sst": "sea_surface_temp", "sal": "ocean_salinity"}
    rows = year_range(fact, year, year).where(F.col("sea_surface_temp").isNotNull())
    return (
        partial_sums(rows, ["month", "station_id"], values)
        .groupBy("month")
        .agg(
            stable_round(merged_avg("sst"), 2).alias("avg_sst"),
            stable_round(merged_avg("sal"), 2).alias("avg_salinity"),
            F.count("*").alias("station_count"),
        )
        .orderBy("month")
        .withColumn("month_name", month_name("month"))
    )


def dashboard_stats(fact: DataFrame, stations: DataFrame, regions: DataFrame) -> DataFrame:
    """One row of totals. Three one-row summaries are stacked and folded."""
    s = stations.agg(
        F.count_if("is_active").alias("stations"),
        F.count_distinct("country").alias("countries"),
    )
    f = fact.agg(
        F.count("*").alias("observations"),
        F.year(F.min("observation_date")).alias("min_year"),
        F.year(F.max("observation_date")).alias("max_year"),
    )
    r = regions.agg(F.count("*").alias("regions"))
    stacked = s.unionByName(f, allowMissingColumns=True).unionByName(r, allowMissingColumns=True)
    names = ["stations", "countries", "observations", "min_year", "max_year", "regions"]
    return stacked.agg(*[F.max(c).alias(c) for c in names]).withColumn(
        "size_mb", F.col("observations") * F.lit(MB_PER_ROW)
    )


def anomaly_pivot(
    obs: DataFrame, columns: Sequence[str] = PIVOT_REGIONS, last: int = 10
) -> DataFrame:
    """Yearly anomaly against the overall mean, one column per region, last years.

    The overall mean comes from the (year, region) sums, so the rows are read once.
    """
    part = partial_sums(
        obs.where(F.col("temp_mean").isNotNull()), ["year", "region"], {"t": "temp_mean"}
    )
    overall = F.sum("t_sum").over(_everything()) / F.sum("t_n").over(_everything())
    cells = part.select(
        "year",
        region_key("region").alias("region"),
        stable_round(F.col("t_sum") / F.col("t_n") - overall, 1).alias("anomaly"),
    )
    table = (
        cells.groupBy("year").pivot("region", list(columns)).agg(F.first("anomaly")).fillna(0.0)
    )
    return last_groups(table, "year", last)


def last_groups(df: DataFrame, c: str, n: int = 10) -> DataFrame:
    """The n greatest groups of an aggregate, in ascending order."""
    return df.orderBy(F.desc(c)).limit(n).orderBy(c)


def precip_outlook(obs: DataFrame, suffix: str = "Africa") -> DataFrame:
    """Mean rain × 12 per region, and that figure times two fixed factors."""
    actual = stable_round(F.avg("precipitation") * 12, 0)
    return (
        obs.where(F.col("precipitation").isNotNull())
        .groupBy("region")
        .agg(actual.alias("a"))
        .orderBy("region")
        .select(
            with_suffix("region", suffix).alias("region"),
            F.col("a").cast("long").alias("actual"),
            (F.col("a") * F.lit(PREDICTED_FACTOR)).cast("long").alias("actual_x0_98"),
            (F.col("a") * F.lit(BASELINE_FACTOR)).cast("long").alias("actual_x1_10"),
        )
    )


def ocean_by_month(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("sea_surface_temp").isNotNull() & F.col("month").between(1, 12))
        .groupBy("month")
        .agg(_avg("sea_surface_temp", "sst", 1), _avg("ocean_salinity", "salinity", 1))
        .orderBy("month")
        .withColumn("month_name", month_name("month"))
    )


def regions_overview(regions: DataFrame, stations: DataFrame, fact: DataFrame) -> DataFrame:
    """Stations and observations per region, zeros kept."""
    per_region = (
        station_counts(stations.select("station_id", "region"), fact)
        .groupBy("region")
        .agg(F.count("*").alias("s"), F.sum("observation_count").alias("o"))
    )
    return (
        regions.select("name", "code")
        .join(per_region, F.col("name") == F.col("region"), "left")
        .select(
            "name",
            "code",
            F.coalesce("s", F.lit(0)).alias("station_count"),
            F.coalesce("o", F.lit(0)).alias("observation_count"),
        )
    )


def region_share(obs: DataFrame) -> DataFrame:
    n = obs.groupBy("region").agg(F.count("*").alias("observation_count"))
    total = F.sum("observation_count").over(_everything())
    return n.withColumn("percent", stable_round(F.col("observation_count") * 100.0 / total, 2))


def station_stats(fact: DataFrame) -> DataFrame:
    return fact.groupBy("station_id").agg(
        F.count("*").alias("total_observations"),
        _avg("temp_mean", "avg_temp"),
        _avg("precipitation", "avg_precipitation"),
        _avg("humidity", "avg_humidity"),
        F.min("observation_date").alias("min_date"),
        F.max("observation_date").alias("max_date"),
    )


def station_extremes(fact: DataFrame) -> DataFrame:
    return fact.groupBy("station_id").agg(
        _avg("temp_mean", "avg_temp"),
        _avg("precipitation", "avg_precip"),
        _avg("humidity", "avg_humidity"),
        F.min("temp_min").alias("min_temp"),
        F.max("temp_max").alias("max_temp"),
        F.count("*").alias("total_observations"),
    )


def station_monthly(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("station_id", "month")
        .agg(_avg("temp_mean", "avg_temp"), _avg("precipitation", "avg_precip"))
        .orderBy("station_id", "month")
    )


def stations_distinct(obs: DataFrame) -> DataFrame:
    """Station attributes found in the observations; coastal if ever a sea reading."""
    attrs = ["station_id", "station_name", "country", "region", "latitude", "longitude"]
    return (
        obs.groupBy(*attrs)
        .agg(F.max("sea_surface_temp").alias("max_sst"))
        .withColumn("is_coastal", F.col("max_sst").isNotNull())
    )


def countries(stations: DataFrame) -> DataFrame:
    """Distinct countries in order, each with the total number of them."""
    names = stations.select("country").distinct()
    return names.withColumn("n_countries", F.count("*").over(_everything())).orderBy("country")


def month_region(obs: DataFrame, year: int = 2024) -> DataFrame:
    return (
        year_range(obs, year, year)
        .where(F.col("temp_mean").isNotNull())
        .groupBy("region", "month")
        .agg(_avg("temp_mean", "avg_temp", 2), _avg("precipitation", "avg_precip", 2), _n())
        .orderBy("region", "month")
    )


def country_extremes(obs: DataFrame, first: int = 2020, last: int = 2024) -> DataFrame:
    return (
        year_range(obs, first, last)
        .groupBy("country")
        .agg(
            F.max("temp_max").alias("hottest_recorded"),
            F.min("temp_min").alias("coldest_recorded"),
            _avg("temp_mean", "avg_temperature", 1),
        )
        .orderBy(F.desc("hottest_recorded"), "country")
    )


def precip_annual(obs: DataFrame, year: int = 2024) -> DataFrame:
    return (
        year_range(obs, year, year)
        .groupBy("region")
        .agg(
            F.sum("precipitation").alias("total_precip"),
            (F.avg("precipitation") * 12).alias("annual_avg"),
        )
    )


def anomaly_by_baseline(obs: DataFrame, baselines: DataFrame) -> DataFrame:
    """Yearly mean minus the region's baseline; aggregated before the join."""
    yearly = obs.groupBy("region", "year").agg(F.avg("temp_mean").alias("m"))
    return (
        yearly.join(baselines, "region")
        .select(
            "region", "year", stable_round(F.col("m") - F.col("baseline_temp"), 2).alias("temp_anomaly")
        )
        .orderBy("year", "region")
    )


def monthly_summary(obs: DataFrame, from_year: int = 2020, date: str | None = None) -> DataFrame:
    """`date` names the date that the year follows from, if it does: the bound then reaches the files."""
    rainy = F.when(F.col("precipitation") > 0, F.lit(1))
    return (
        year_range(obs, from_year, date=date)
        .where(F.col("temp_mean").isNotNull())
        .groupBy("station_id", "country", "month", "year", "region")
        .agg(
            _avg("temp_mean", "avg_temperature"),
            F.max("temp_max").alias("max_temperature"),
            F.min("temp_min").alias("min_temperature"),
            F.sum("precipitation").alias("total_precipitation"),
            F.count(rainy).alias("rainy_days"),
            _avg("sea_surface_temp", "avg_sst"),
            _avg("ocean_salinity", "avg_salinity"),
            _n(),
        )
    )


def monthly_climate(obs: DataFrame) -> DataFrame:
    return obs.groupBy("region", "year", "month").agg(
        _avg("temp_mean", "avg_temp"), F.sum("precipitation").alias("total_precip"), _n()
    )


def scenario_agg(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("region", "year")
        .agg(_avg("temp_mean", "avg_temp"), F.sum("precipitation").alias("total_precip"), _n())
        .orderBy("region", "year")
    )


def big_spenders(
    sales: DataFrame, customers: DataFrame, key: str, name: str, amount: str,
    at_least: float = 5000.0, k: int = 100,
) -> DataFrame:
    """Customers above a spending threshold, greatest first; grouped before the join."""
    spent = (
        sales.groupBy(key)
        .agg(
            F.count("*").alias("purchase_count"),
            F.sum(amount).alias("total_spent"),
            F.avg(amount).alias("avg_transaction_value"),
        )
        .where(F.col("total_spent") > at_least)
    )
    return spent.join(customers.select(key, name), key).orderBy(F.desc("total_spent"), key).limit(k)


def request_stats(log: DataFrame, user: str, value: str) -> DataFrame:
    """Requests, distinct users and mean time of a log.

    Reduced per user first: the distinct count becomes a count of groups.
    """
    part = (
        log.groupBy(user)
        .agg(F.count("*").alias("r"), F.sum(value).alias("s"), F.count(value).alias("c"))
    )
    return part.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("total_requests"),
        F.count(user).alias("unique_users"),
        stable_round(F.try_divide(F.sum("s"), F.sum("c")), 2).alias("avg_time"),
    )


def top_countries(fact: DataFrame, stations: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most observations, numbered."""
    part = partial_sums(fact, ["station_id"], {"temp": "temp_mean"})
    rows = (
        part.join(stations.select("station_id", "country", "region"), "station_id")
        .groupBy("country", "region")
        .agg(F.sum("rows").alias("observation_count"), merged_avg("temp").alias("avg_temp"))
    )
    order = [F.desc("observation_count"), F.asc("country"), F.asc("region")]
    # k rows are left when they are numbered.
    number = F.row_number().over(_everything().orderBy(*order))
    return rows.orderBy(*order).limit(k).withColumn("position", number)
