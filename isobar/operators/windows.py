"""Window measures over station histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.functions.columns import stable_round, units
from isobar.operators.filters import year_range
from isobar.operators.skew import GROUP_ROWS, in_blocks, numbered, split_hot

SCALE = 5


def _trailing_anomaly(rows: DataFrame, group: Sequence[str], order, value: str, back: int):
    """value − mean of the `back` rows before, by running sums.

    A sliding frame adds up `back` values per row. Two readings of one running
    sum give the same total; whole units keep the difference exact.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(units(value, SCALE)).over(past)
    rows = rows.withColumn("_sum", F.coalesce(total, F.lit(0))).withColumn(
        "_rank", F.row_number().over(w)
    )
    older = F.coalesce(F.lag("_sum", back).over(w), F.lit(0))
    n = F.least(F.col("_rank") - 1, F.lit(back))
    mean = F.try_divide(F.col("_sum") - older, n) / F.lit(float(10**SCALE))
    return rows.withColumn("_anomaly", F.col(value) - mean).drop("_sum", "_rank")


def sst_anomaly(
    fact: DataFrame,
    tie: Sequence[str] = (),
    from_year: int = 2020,
    back: int = 365,
    max_group_rows: int = GROUP_ROWS,
    block_rows: int = 1_000_000,
    keep: Sequence[str] = (),
    date: str | None = None,
) -> DataFrame:
    """Sea-surface temperature against the mean of the station's `back` rows before.

    A station's first row has no past and gives NULL. Ordinary stations take
    one shuffle; stations above `max_group_rows` are numbered by a range
    shuffle and cut into blocks that carry the `back` rows before them.
    Where the year follows from a date, `date` names it and the bound reaches the files.
    """
    rows = year_range(fact, from_year, date=date).where(F.col("sea_surface_temp").isNotNull()).select(
        "station_id", "observation_date", "sea_surface_temp", *tie, *keep
    )
    order = [F.col("observation_date"), *[F.col(c) for c in tie]]
    cold, hot = split_hot(rows, ["station_id"], max_group_rows)
    out = _trailing_anomaly(cold, ["station_id"], order, "sea_surface_temp", back)
    if hot is not None:
        blocks = in_blocks(numbered(hot, ["station_id"], order), "pos", block_rows, back)
        done = _trailing_anomaly(
            blocks, ["station_id", "_block"], [F.col("pos")], "sea_surface_temp", back
        )
        out = out.unionByName(done.where("_own").drop("_own", "_block", "pos"))
    return out.withColumn("sst_anomaly", stable_round("_anomaly", 2)).drop("_anomaly")


def top_sst_anomalies(fact: DataFrame, tie: Sequence[str] = (), k: int = 100, **kw) -> DataFrame:
    """The k greatest anomalies."""
    order = [
        F.col("sst_anomaly").desc_nulls_last(),
        F.col("station_id"),
        F.col("observation_date"),
        *[F.col(c) for c in tie],
    ]
    return sst_anomaly(fact, tie, **kw).orderBy(*order).limit(k)


def rolling_precip(fact: DataFrame, days: int = 30) -> DataFrame:
    """Rain of the last `days` calendar days, per station and day.

    Rows are summed per day first, so a window holds one row per calendar day.
    """
    daily = fact.groupBy("station_id", "observation_date").agg(
        F.sum(units("precipitation", SCALE)).alias("_units")
    )
    w = (
        Window.partitionBy("station_id")
        .orderBy(F.unix_date("observation_date"))
        .rangeBetween(-(days - 1), 0)
    )
    rolled = F.sum("_units").over(w) / F.lit(float(10**SCALE))
    return daily.select(
        "station_id", "observation_date", stable_round(rolled, 2).alias("rolling_precip")
    )


def year_over_year(obs: DataFrame) -> DataFrame:
    """Change of a region's monthly mean against the same month one year before.

    NULL when the year before is missing. Aggregated before the window.
    """
    return year_over_year_of(obs.groupBy("region", "month", "year").agg(F.avg("temp_mean").alias("_mean")))


def year_over_year_of(monthly: DataFrame) -> DataFrame:
    """year_over_year of monthly means, in column `_mean`."""
    w = Window.partitionBy("region", "month").orderBy("year")
    before = F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag("_mean").over(w))
    return monthly.select(
        "region",
        "month",
        "year",
        stable_round("_mean", 2).alias("avg_temp"),
        stable_round(F.col("_mean") - before, 2).alias("change"),
    )


def recent_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first n rows of every key. The limit per key is applied before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return recent_n(df, keys, order, 1).drop("recency")


def ranked(df: DataFrame, order: Sequence[Column], tie: Sequence[Column]) -> DataFrame:
    """Rank and row number over an already aggregated frame."""
    w = Window.partitionBy(F.lit(1))
    return df.withColumn("rank", F.rank().over(w.orderBy(*order))).withColumn(
        "position", F.row_number().over(w.orderBy(*order, *tie))
    )
