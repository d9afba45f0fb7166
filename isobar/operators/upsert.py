"""Keyed upserts, insert-if-absent, and their bookkeeping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators.windows import latest_per_key
from isobar.session import work_path
from isobar.sources.tables import append_rows, overwrite_partitions


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key; copies of a key are cut before the shuffle."""
    return latest_per_key(df, keys, order)


def merge_flagged(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """Target and incoming merged by key, each row with its `action`.

    Keys must be unique on both sides; NULL is a key like any other. An incoming row overwrites the update
    columns, with NULLs too; presence is a flag, not the value. Columns missing
    in the incoming rows keep the target's value. Without `null_keys` no incoming key holds
    a NULL: rows that were cut to one per key before are then joined as they lie.
    """
    t = target.select(
        *[F.col(k).alias(f"_t_{k}") for k in keys],
        *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
        F.lit(True).alias("_t"),
    )
    i = incoming.select(*[c for c in target.columns if c in incoming.columns]).withColumn(
        "_i", F.lit(True)
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"_t_{k}").eqNullSafe(F.col(k)) if null_keys else F.col(f"_t_{k}") == F.col(k))
    both = t.join(i, cond, "full_outer")
    action = (
        F.when(F.col("_t") & F.col("_i"), F.lit("updated"))
        .when(F.col("_i"), F.lit("created"))
        .otherwise(F.lit("kept"))
    )
    out = []
    for c in target.columns:
        old = F.col(f"_t_{c}")
        if c in keys:
            value = F.coalesce(F.col(c), old)
        elif c not in incoming.columns:
            value = old
        elif c in update_cols:
            value = F.when(F.col("_i"), F.col(c)).otherwise(old)
        else:
            value = F.when(F.col("_t"), old).otherwise(F.col(c))
        out.append(value.alias(c))
    return both.select(*out, action.alias("action"))


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """merge_flagged after cutting the incoming rows to one per key (first by `order`)."""
    if order:
        incoming = first_per_key(incoming, keys, order)
    return merge_flagged(target, incoming, keys, update_cols)


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Incoming rows whose key is new; the first of equal keys wins."""
    fresh = incoming.join(target.select(*keys), list(keys), "left_anti")
    return first_per_key(fresh, keys, order)


def action_counts(flagged: DataFrame, entity: str) -> DataFrame:
    """Rows really written, by kind, as one row."""
    return flagged.agg(
        F.lit(entity).alias("entity"),
        F.count_if(F.col("action") == "created").alias("created"),
        F.count_if(F.col("action") == "updated").alias("updated"),
        F.count_if(F.col("action") == "skipped").alias("skipped"),
        F.count_if(F.col("action") == "error").alias("errors"),
    )


def touched_partitions(target: DataFrame, incoming: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The target's rows in partitions that the incoming rows touch.

    The distinct (year, region) values of a load are few; as literals they
    prune the target's files when the plan is made.
    """
    return in_partitions(target, incoming.select(*parts).distinct().collect(), parts)


def in_partitions(target: DataFrame, values: Sequence[Row], parts: Sequence[str]) -> DataFrame:
    """The target's rows in the partitions named."""
    if not values:
        return target.where(F.lit(False))
    cond = F.lit(False)
    for row in values:
        one = F.lit(True)
        for p in parts:
            one = one & F.col(p).eqNullSafe(F.lit(row[p]))
        cond = cond | one
    return target.where(cond)


def staged_upsert(
    spark: SparkSession,
    table: str,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    parts: Sequence[str] = ("year", "region"),
    order: Sequence[Column] = (),
    touched: Sequence[Row] | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """The touched partitions of a table as they will be, with actions, written to the shared folder.

    The partition columns must follow from the key (year from the date, region
    from the station): a key then lies in one partition. Nothing is published yet.
    `touched` names the partitions if they are known; `null_keys` is that of merge_flagged.
    """
    if order:
        incoming = first_per_key(incoming, keys, order)
    old = spark.table(table)
    old = touched_partitions(old, incoming, parts) if touched is None else in_partitions(old, touched, parts)
    stage = work_path(spark, "stage")
    merge_flagged(old, incoming, keys, update_cols, null_keys).write.parquet(stage)
    return spark.read.parquet(stage)


def upsert_table(
    spark: SparkSession,
    table: str,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    parts: Sequence[str] = ("year", "region"),
    order: Sequence[Column] = (),
    entity: str = "observations",
) -> DataFrame:
    """Upsert into a partitioned table, rewriting touched partitions only.

    The merged rows are staged first, since a table cannot be overwritten while it
    is read; the counts are taken from the staged rows.
    """
    staged = staged_upsert(spark, table, incoming, keys, update_cols, parts, order)
    overwrite_partitions(staged.drop("action"), table)
    return action_counts(staged, entity)


def log_load(
    spark: SparkSession,
    table: str,
    counts: DataFrame,
    source: str,
    start: dt.datetime,
    end: dt.datetime,
    status: str = "completed",
    load_id: str | None = None,
    newest: dt.date | None = None,
) -> None:
    """Append the counts of a load to the load log; `newest` is the last day it carried."""
    rows = counts.select(
        "entity",
        F.lit(source).alias("source"),
        F.lit(status).alias("status"),
        F.lit(start).cast("timestamp").alias("start_time"),
        F.lit(end).cast("timestamp").alias("end_time"),
        "created",
        "updated",
        "skipped",
        "errors",
        F.lit(load_id).cast("string").alias("load_id"),
        F.lit(newest).cast("date").alias("newest"),
    )
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], schemas.LOAD_LOG).write.format("parquet").saveAsTable(table)
    append_rows(rows, table)


def completed_loads(spark: SparkSession, table: str, source: str) -> DataFrame | None:
    """Logged loads of a source that came to their end; None without a log."""
    if not spark.catalog.tableExists(table):
        return None
    spark.catalog.refreshTable(table)
    return spark.table(table).where((F.col("source") == source) & (F.col("status") == "completed"))


def high_water(spark: SparkSession, table: str, source: str) -> dt.date | None:
    """The newest day any completed load of the source carried, by the load log."""
    done = completed_loads(spark, table, source)
    return None if done is None else done.agg(F.max("newest")).first()[0]


def defaults(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Add columns the frame lacks."""
    return df.withColumns({c: v for c, v in values.items() if c not in df.columns})
