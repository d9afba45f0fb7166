"""Sorts, top-k, pages, splits and distribution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.operators.skew import GROUP_ROWS, numbered

# Up to this many rows one task may receive for a top-k or page.
HEAP_ROWS = 10_000


def sort_multi(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def _day_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows per day with the number of rows on newer days; bounded by the calendar."""
    newer = (
        Window.partitionBy(F.lit(1))
        .orderBy(F.desc_nulls_last("_day"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.groupBy(F.col(date).alias("_day"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
    )


def newest(
    df: DataFrame,
    k: int,
    tie: Sequence[str],
    date: str = "observation_date",
    max_day_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The k newest rows under a total order (date descending, then tie).

    Every task's heap would ship k rows to one task, however many tasks there
    are. So the day of the k-th row is found from day counts; the bound reaches
    the file scan, and only rows from that day on are sorted. If those are still
    many, one heavy day say, they are numbered by a range shuffle instead.
    """
    order = [F.col(date).desc_nulls_last(), *[F.col(c) for c in tie]]
    reach = _day_counts(df, date).where(F.col("_newer") < k)
    cut = reach.agg(
        F.min("_day").alias("first"), F.sum("_n").alias("rows"), F.count_if(F.col("_day").isNull()).alias("undated")
    ).first()
    if cut["rows"] is None:
        return df.where(F.lit(False))
    if not cut["undated"]:
        df = df.where(F.col(date) >= F.lit(cut["first"]))
    if cut["rows"] <= max_day_rows:
        return df.orderBy(*order).limit(k)
    return numbered(df, [], order, "_pos").where(F.col("_pos") <= k).drop("_pos").orderBy(*order)


def page(
    df: DataFrame,
    tie: Sequence[str],
    number: int = 1,
    size: int = 100,
    date: str = "observation_date",
    max_day_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Page `number` (from 1) of the rows, newest first, then by tie.

    Near pages are a top-k. For a far one, day counts tell which days the page
    lies in; only those days are read and sorted, however far the page is.
    """
    order = [F.col(date).desc_nulls_last(), *[F.col(c) for c in tie]]
    skip = (number - 1) * size
    if skip + size <= HEAP_ROWS:
        return df.orderBy(*order).offset(skip).limit(size)
    cover = _day_counts(df, date).where(
        (F.col("_newer") < skip + size) & (F.col("_newer") + F.col("_n") > skip)
    )
    span = cover.agg(
        F.min("_day").alias("first"),
        F.max("_day").alias("last"),
        F.count_if(F.col("_day").isNull()).alias("undated"),
        F.min("_newer").alias("newer"),
        F.sum("_n").alias("rows"),
    ).first()
    if span["newer"] is None:
        return df.where(F.lit(False))
    inside = F.lit(False)
    if span["first"] is not None:
        inside = F.col(date).between(F.lit(span["first"]), F.lit(span["last"]))
    if span["undated"]:
        inside = inside | F.col(date).isNull()
    skip -= span["newer"]
    if span["rows"] <= max_day_rows:
        return df.where(inside).orderBy(*order).offset(skip).limit(size)
    rows = numbered(df.where(inside), [], order, "_pos")
    return rows.where(F.col("_pos").between(skip + 1, skip + size)).drop("_pos").orderBy(*order)


def page_by(df: DataFrame, order: Sequence[Column], number: int = 1, size: int = 100) -> DataFrame:
    """Page `number` (from 1) under any total order.

    Near pages are a top-k, far ones take distributed row numbers.
    """
    skip = (number - 1) * size
    if skip + size <= HEAP_ROWS:
        return df.orderBy(*order).offset(skip).limit(size)
    rows = numbered(df, [], order, "_pos")
    return rows.where(F.col("_pos").between(skip + 1, skip + size)).drop("_pos").orderBy(*order)


def _cut_day(df: DataFrame, fraction: float, date: str):
    """The day in which the newest ⌊fraction · n⌋ rows end: `_day`, its rows `_n`, `_take` of them; or None."""
    days = _day_counts(df, date).withColumn("_all", F.sum("_n").over(Window.partitionBy(F.lit(1))))
    wanted = F.floor(F.col("_all") * F.lit(fraction))
    return (
        days.where((F.col("_newer") < wanted) & (wanted <= F.col("_newer") + F.col("_n")))
        .select("_day", "_n", (wanted - F.col("_newer")).alias("_take"))
        .first()
    )


def _placed(day: DataFrame, rows: int, tie: Sequence[str], date: str, max_day_rows: int) -> DataFrame:
    """The rows of one day with their place `_pos` under `tie`."""
    if not tie:
        raise ValueError("a split needs `tie` columns that tell rows of a day apart")
    order = [F.col(c) for c in tie]
    if rows > max_day_rows:
        return numbered(day, [], order, "_pos")
    return day.withColumn("_pos", F.row_number().over(Window.partitionBy(date).orderBy(*order)))


def split_by_time(
    df: DataFrame,
    fraction: float,
    tie: Sequence[str],
    date: str = "observation_date",
    max_day_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Adds `split`: the newest ⌊fraction · n⌋ rows are train, the others test.

    Whole days are decided by date; only the day the cut falls in is numbered.
    """
    cut = _cut_day(df, fraction, date)
    if cut is None:
        return df.withColumn("split", F.lit("test"))
    if cut["_day"] is None:
        # The cut falls among the rows without a date: all dated ones are newer.
        is_cut, newer = F.col(date).isNull(), F.lit(True)
    else:
        is_cut = F.col(date).eqNullSafe(F.lit(cut["_day"]))
        newer = F.coalesce(F.col(date) > F.lit(cut["_day"]), F.lit(False))
    rest = df.where(~is_cut).withColumn("split", F.when(newer, "train").otherwise("test"))
    day = _placed(df.where(is_cut), cut["_n"], tie, date, max_day_rows)
    side = F.when(F.col("_pos") <= cut["_take"], "train").otherwise("test")
    return rest.unionByName(day.withColumn("split", side).drop("_pos"))


def split_frames(
    df: DataFrame,
    fraction: float,
    tie: Sequence[str],
    date: str = "observation_date",
    max_day_rows: int = GROUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """split_by_time as two frames (train, test), each bounded by date where it reads the files.

    A day with rows on both sides is read for each; all other rows are read for one.
    """
    cut = _cut_day(df, fraction, date)
    if cut is None:
        return df.where(F.lit(False)), df
    at, c = F.lit(cut["_day"]), F.col(date)
    if cut["_day"] is None:
        train, test, same = df.where(c.isNotNull()), None, c.isNull()
    else:
        train, test, same = df.where(c > at), df.where(c < at).unionByName(df.where(c.isNull())), c == at
    if cut["_take"] == cut["_n"]:
        train = train.unionByName(df.where(same))
        return train, df.where(F.lit(False)) if test is None else test
    day = _placed(df.where(same), cut["_n"], tie, date, max_day_rows)
    older = day.where(F.col("_pos") > cut["_take"]).drop("_pos")
    train = train.unionByName(day.where(F.col("_pos") <= cut["_take"]).drop("_pos"))
    return train, older if test is None else test.unionByName(older)


def distribute_sort(df: DataFrame, by: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Rows brought together by `by` and sorted within each partition.

    Ranges over (by, sort) keep a key's rows adjacent and let a large key take
    as many partitions as it needs; hashing `by` alone would give it one.
    """
    return df.repartitionByRange(*by, *sort).sortWithinPartitions(*by, *sort)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()
