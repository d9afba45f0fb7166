"""Size checks and exact ways around hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.session import shared_dir

# What a broadcast side may have: rows, and bytes of its columns.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# Rows one window group may have before it is split into blocks.
GROUP_ROWS = 5_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after measuring; a larger side joins by shuffle.

    Meant for dimension tables, where the count is answered by file footers; texts of
    those that pass are measured too.
    """
    rows = df.count()
    if rows > max_rows:
        return df
    texts = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    held = 8 * rows * len(df.columns)
    if texts:
        size = F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts[1:]), F.coalesce(F.octet_length(texts[0]), F.lit(0))))
        held += df.agg(size).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def measured(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a small aggregate once, count it, and hint a broadcast if it is small.

    The checkpoint lies in the shared folder, so losing an executor does not
    recompute the aggregate.
    """
    shared_dir(df.sparkSession)
    return broadcast_if_small(df.checkpoint(), max_rows)


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = GROUP_ROWS) -> DataFrame | None:
    """Keys with more than max_rows rows, or None. At most rows/max_rows of them."""
    shared_dir(df.sparkSession)
    hot = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > max_rows)
        .select(*keys)
        .checkpoint()
    )
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame, keys: Sequence[str], max_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None); together all rows."""
    hot = hot_keys(df, keys, max_rows)
    if hot is None:
        return df, None
    hot = broadcast_if_small(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return df.join(hot, cond, "left_anti"), df.join(hot, cond, "left_semi")


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: Column, name: str
) -> DataFrame:
    """Sum of weights up to each row under a total order, without putting a key in one task.

    A range shuffle on (keys, order) spreads even a single key over many
    partitions. Weights are summed up inside each piece, and each piece gets as
    offset the total of the pieces of the same key before it.
    """
    shared_dir(df.sparkSession)
    # The pieces come from sampled bounds: written once, both uses below agree.
    pieces = (
        df.withColumn("_weight", weight)
        .repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("_piece", F.spark_partition_id())
        .checkpoint()
    )
    group = [*keys, "_piece"]
    sizes = pieces.groupBy(*group).agg(F.sum("_weight").alias("_size"))
    before = Window.partitionBy(*(keys or [F.lit(1)])).orderBy("_piece")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_r_{c}") for c in group],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cond = F.lit(True)
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return (
        pieces.withColumn("_local", F.sum("_weight").over(inside))
        .join(measured(offsets), cond)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_weight", "_piece", "_local", "_offset", *[f"_r_{c}" for c in group])
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "pos"
) -> DataFrame:
    """Row number per key under a total order, as a running total of ones."""
    return running_total(df, keys, order, F.lit(1).cast("long"), name)


def in_blocks(
    df: DataFrame, pos: str, block_rows: int, halo: int
) -> DataFrame:
    """Cut numbered rows into blocks, each with the `halo` rows before it.

    Adds `_block` and `_own`: a frame that looks back at most `halo` rows gives
    the right value on rows with `_own`; the others are dropped afterwards.
    """
    home = F.floor((F.col(pos) - 1) / F.lit(block_rows)).cast("long")
    # A small block may serve several later blocks.
    last = F.floor((F.col(pos) - 1 + F.lit(halo)) / F.lit(block_rows)).cast("long")
    return (
        df.withColumn("_home", home)
        .withColumn("_block", F.explode(F.sequence(F.col("_home"), last)))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )


def salted_avg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    spread: Sequence[str],
    salts: int = 64,
) -> DataFrame:
    """Two-phase grouping of a skewed key: (key, salt) first, then key.

    The average is rebuilt from sum and count. `spread` names columns whose
    hash gives the salt, so that a repeated task salts alike.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts))
    part = (
        df.withColumn("_salt", salt)
        .groupBy(*keys, "_salt")
        .agg(
            F.sum(value).alias("_sum"),
            F.count(value).alias("_n"),
            F.count("*").alias("_rows"),
        )
    )
    return part.groupBy(*keys).agg(
        F.sum("_rows").alias("n"),
        F.sum("_sum").alias("total"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean"),
    )
