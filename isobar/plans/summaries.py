"""Summaries kept up to date: mergeable partial state in a table, changed by deltas.

State is one row a group: rows, and of each measure the sum in whole units, the number of
values, the least and the greatest. Rows that come add to it, rows that go are taken
away; sums are exact, so state does not depend on the order of changes. A least or
greatest value that goes leaves its group without one: such groups, and only they, are
worked out from their rows again. A change rewrites only partitions of groups it touches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.columns import stable_round, units
from isobar.operators.upsert import touched_partitions
from isobar.operators.windows import rolling_precip, year_over_year_of
from isobar.session import work_path
from isobar.sources.tables import overwrite_partitions, write_warehouse

#: Decimal places that sums are exact to; values may have nine digits before them.
SCALE = 9


@dataclass(frozen=True)
class Summary:
    """A state table, its keys (`part` among them) and the measures it holds."""

    table: str
    keys: tuple[str, ...] = ("region", "year", "month")
    measures: tuple[str, ...] = ("temp_mean", "precipitation")
    part: str = "year"


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _exact(total: Column) -> Column:
    return total.cast("decimal(38,0)")


def partials(rows: DataFrame, s: Summary) -> DataFrame:
    """State of some rows, combined before the shuffle."""
    parts = [F.count("*").alias("rows")]
    for m in s.measures:
        parts += [
            _exact(F.sum(units(m, SCALE).cast("decimal(19,0)"))).alias(f"{m}_sum"),
            F.count(m).alias(f"{m}_n"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
        ]
    return rows.groupBy(*s.keys).agg(*parts)


def create(rows: DataFrame, s: Summary, path: str | None = None) -> DataFrame:
    return write_warehouse(partials(rows, s), s.table, (s.part,), None, path=path, fmt="parquet")


def _signed(state: DataFrame, s: Summary, sign: int) -> DataFrame:
    """State as a change: what goes has no extremes to offer, but extremes that may be lost."""
    cols = [*s.keys, (F.col("rows") * sign).alias("rows")]
    for m in s.measures:
        cols += [(F.col(f"{m}_sum") * sign).cast("decimal(38,0)").alias(f"{m}_sum"), (F.col(f"{m}_n") * sign).alias(f"{m}_n")]
        for edge in ("min", "max"):
            value, none = F.col(f"{m}_{edge}"), F.lit(None).cast(state.schema[f"{m}_{edge}"].dataType)
            cols += [(value if sign > 0 else none).alias(f"{m}_{edge}"), (none if sign > 0 else value).alias(f"{m}_{edge}_lost")]
    return state.select(*cols)


def _merged(changes: DataFrame, s: Summary) -> DataFrame:
    """Signed states folded to one row a group, with `stale` where an extreme went."""
    parts, stale = [F.sum("rows").alias("rows")], F.lit(False)
    for m in s.measures:
        parts += [_exact(F.sum(f"{m}_sum")).alias(f"{m}_sum"), F.sum(f"{m}_n").alias(f"{m}_n")]
        for edge, fold in (("min", F.min), ("max", F.max)):
            parts += [fold(f"{m}_{edge}").alias(f"{m}_{edge}"), fold(f"{m}_{edge}_lost").alias(f"{m}_{edge}_lost")]
        stale = stale | F.coalesce(F.col(f"{m}_min_lost") <= F.col(f"{m}_min"), F.lit(False))
        stale = stale | F.coalesce(F.col(f"{m}_max_lost") >= F.col(f"{m}_max"), F.lit(False))
    lost = [f"{m}_{edge}_lost" for m in s.measures for edge in ("min", "max")]
    out = changes.groupBy(*s.keys).agg(*parts).withColumn("stale", stale & (F.col("rows") > 0)).drop(*lost)
    # A measure without values has neither sum nor extremes.
    held = {f"{m}_{k}": F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_{k}")) for m in s.measures for k in ("sum", "min", "max")}
    return out.withColumns(held)


def change(
    spark: SparkSession,
    s: Summary,
    rows: DataFrame,
    added: DataFrame | None = None,
    removed: DataFrame | None = None,
) -> None:
    """Bring the state up to date after rows were added and removed; an update does both.

    `rows` is the whole table as it is after the change; only rows of stale groups are
    read, in partitions the change touches. Null keys are keys. Groups that lose all their
    rows stay in the state with none, so that their partition is replaced; `monthly` leaves them out.
    """
    deltas = [_signed(partials(df, s), s, sign) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    if not deltas:
        return
    delta = deltas[0] if len(deltas) == 1 else deltas[0].unionByName(deltas[1])
    delta = _staged(delta, "summary-delta")
    old = touched_partitions(spark.table(s.table), delta, (s.part,))
    state = _staged(_merged(_signed(old, s, 1).unionByName(delta), s), "summary-state")
    stale = _staged(state.where("stale").select(*s.keys), "summary-stale")
    fresh = touched_partitions(rows, stale, (s.part,)).alias("r").join(stale.alias("k"), _same(s.keys), "left_semi")
    state = state.where("not stale").drop("stale").unionByName(partials(fresh, s))
    overwrite_partitions(_staged(state, "summary-state"), s.table)


def _same(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}"))
    return cond


def rebuild(rows: DataFrame, s: Summary) -> None:
    """State of the partitions that the rows lie in, from these rows alone."""
    overwrite_partitions(partials(rows, s), s.table)


def mean(measure: str) -> Column:
    """The mean of a measure in a state row, NULL without values."""
    total = F.col(f"{measure}_sum").cast("double") / F.lit(float(10**SCALE))
    return F.try_divide(total, F.col(f"{measure}_n"))


def total(measure: str) -> Column:
    value = F.col(f"{measure}_sum").cast("double") / F.lit(float(10**SCALE))
    return F.when(F.col(f"{measure}_n") > 0, value)


def monthly(spark: SparkSession, s: Summary) -> DataFrame:
    """The monthly climate summary as the state has it."""
    return spark.table(s.table).where("rows > 0").select(
        *s.keys,
        mean("temp_mean").alias("avg_temp"),
        total("precipitation").alias("total_precip"),
        F.col("temp_mean_min").alias("min_temp"),
        F.col("temp_mean_max").alias("max_temp"),
        F.col("rows").alias("observation_count"),
    )


# -- windows across partition borders ----------------------------------------


def create_rolling(published: DataFrame, table: str, days: int = 30, path: str | None = None) -> DataFrame:
    """Rain of the last `days` days per station and day, by (year, month)."""
    return write_warehouse(_dated(rolling_precip(published, days)), table, ("year", "month"), None, path=path, fmt="parquet")


def _dated(rolled: DataFrame) -> DataFrame:
    day = F.col("observation_date")
    return rolled.withColumns({"year": F.year(day), "month": F.month(day)})


def refresh_rolling(spark: SparkSession, published: DataFrame, table: str, year: int, days: int = 30) -> None:
    """After a year was reloaded: its months again, and those after it that still look back on it.

    Days before the year are read as far as its first windows reach; the files are pruned
    by year and by date.
    """
    first = dt.date(year, 1, 1)
    reach = dt.date(year, 12, 31) + dt.timedelta(days=days - 1)
    # Months are replaced whole.
    last = (reach.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    start = first - dt.timedelta(days=days - 1)
    day = F.col("observation_date")
    rows = published.where(F.col("year").between(start.year, last.year) & day.between(F.lit(start), F.lit(last)))
    rolled = _staged(_dated(rolling_precip(rows, days).where(day >= F.lit(first))), "rolling")
    overwrite_partitions(rolled, table)
    _drop_empty(spark, table, rolled, first, last)


def _drop_empty(spark: SparkSession, table: str, rolled: DataFrame, first: dt.date, last: dt.date) -> None:
    """Months of the range that have no rows any more: dynamic overwrite leaves them."""
    there = {tuple(r) for r in rolled.select("year", "month").distinct().collect()}
    while first <= last:
        if (first.year, first.month) not in there:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year={first.year}, month={first.month})")
        first = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def yearly_change(state: DataFrame) -> DataFrame:
    """Change of a region's monthly mean against the year before, from the state."""
    means = state.where("rows > 0").select("region", "month", "year", mean("temp_mean").alias("_mean"))
    return year_over_year_of(means)


def create_change(spark: SparkSession, s: Summary, table: str, path: str | None = None) -> DataFrame:
    return write_warehouse(yearly_change(spark.table(s.table)), table, ("year",), None, path=path, fmt="parquet")


def refresh_change(spark: SparkSession, s: Summary, table: str, year: int) -> None:
    """After a year changed: its changes and those of the next year, from three years of state."""
    state = spark.table(s.table).where(F.col("year").between(year - 1, year + 1))
    rows = yearly_change(state).where(F.col("year").between(year, year + 1))
    overwrite_partitions(_staged(rows, "change"), table)


# -- the published outputs of the pipeline -----------------------------------


@dataclass(frozen=True)
class Outputs:
    """Catalog names of the published observations and of what is derived from them."""

    published: str
    summary: Summary
    rolling: str
    change: str


def publish_outputs(spark: SparkSession, names: Outputs) -> None:
    """All three outputs of the published observations."""
    published = spark.table(names.published)
    create(published, names.summary, work_path(spark, "summary"))
    create_rolling(published, names.rolling, path=work_path(spark, "rolling-table"))
    create_change(spark, names.summary, names.change, work_path(spark, "change-table"))


def reload_year(spark: SparkSession, names: Outputs, rows: DataFrame, year: int) -> None:
    """Publish a year's observations again and bring the outputs up to date.

    `rows` are all observations of the year. Read are that year, the days before and
    after it that windows reach, and the state of the years beside it. Regions of the
    year that the rows no longer have are emptied.
    """
    columns = spark.table(names.published).columns
    # A table cannot be overwritten while it is read.
    new = _staged(rows.where(F.col("year") == year).select(*columns), "reload")
    old = spark.table(names.published).where(F.col("year") == year)
    gone = {r[0] for r in old.select("region").distinct().collect()} - {r[0] for r in new.select("region").distinct().collect()}
    removed = _staged(partials(old, names.summary), "removed")
    overwrite_partitions(new, names.published)
    for region in gone:
        value = "NULL" if region is None else "'" + str(region).replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {names.published} DROP IF EXISTS PARTITION (year={int(year)}, region={value})")
    spark.catalog.refreshTable(names.published)
    published = spark.table(names.published)
    # All rows of the year's groups are new: their state is that of the rows.
    emptied = removed.join(new.select(*names.summary.keys).distinct(), list(names.summary.keys), "left_anti")
    zero = {f"{m}_{k}": F.lit(None).cast(removed.schema[f"{m}_{k}"].dataType) for m in names.summary.measures for k in ("min", "max", "sum")}
    zero |= {f"{m}_n": F.lit(0).cast("long") for m in names.summary.measures} | {"rows": F.lit(0).cast("long")}
    state = partials(published.where(F.col("year") == year), names.summary).unionByName(emptied.withColumns(zero))
    overwrite_partitions(_staged(state, "summary-state"), names.summary.table)
    refresh_rolling(spark, published, names.rolling, year)
    refresh_change(spark, names.summary, names.change, year)
