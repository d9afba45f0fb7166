"""A published table in two levels: ordinary keys in buckets, hot keys ranged by date beside them.

One task reads a bucket of a partition. A key with more rows there than a task should
take is hot: its rows lie in a table of their own, in files of bounded size along (key,
date). A view over both is the table. Joins of the bucketed part need no exchange; hot
keys are few, and join by sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from isobar.operators.skew import GROUP_ROWS, broadcast_if_small, hot_keys
from isobar.session import work_path
from isobar.sources.tables import OVERWRITE_MODE, overwrite_partitions, write_warehouse


@dataclass(frozen=True)
class Layout:
    """`name` is the view; `max_rows` are the most rows a key may have in a bucket of one partition."""

    name: str
    parts: tuple[str, ...] = ("year", "region")
    key: str = "station_id"
    date: str = "observation_date"
    buckets: int = 32
    max_rows: int = GROUP_ROWS

    @property
    def cold(self) -> str:
        return f"{self.name}_cold"

    @property
    def hot(self) -> str:
        return f"{self.name}_hot"


def publish(df: DataFrame, layout: Layout, path: str | None = None) -> DataFrame:
    """Replace the whole table; returns the view."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in layout.parts] + list(layout.parts)
    df = df.select(*columns)
    hot = _hot_keys(df, layout)
    under = {level: f"{path}_{level}" if path else None for level in ("cold", "hot")}
    write_warehouse(_side(df, layout, hot, False), layout.cold, layout.parts, layout.buckets, layout.key, under["cold"])
    write_warehouse(df.where(F.lit(False)), layout.hot, layout.parts, None, path=under["hot"])
    _insert_hot(_side(df, layout, hot, True), layout)
    both = " UNION ALL ".join(f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {t}" for t in (layout.cold, layout.hot))
    spark.sql(f"CREATE OR REPLACE VIEW {layout.name} AS {both}")
    return spark.table(layout.name)


def reload(df: DataFrame, layout: Layout) -> None:
    """Replace those partitions that occur in the frame.

    Keys that are hot already stay so; a key may become hot with these rows, and its
    other partitions then follow when they are loaded again. The frame must not read the table.
    """
    spark = df.sparkSession
    df = df.select(*spark.table(layout.cold).columns)
    hot = _hot_keys(df, layout, spark.table(layout.hot).select(layout.key).distinct())
    touched = df.select(*layout.parts).distinct().collect()
    cold, warm = _side(df, layout, hot, False), _side(df, layout, hot, True)
    overwrite_partitions(cold, layout.cold)
    _insert_hot(warm, layout)
    for rows, table in ((cold, layout.cold), (warm, layout.hot)):
        _drop_missing(spark, table, touched, rows.select(*layout.parts).distinct().collect(), layout.parts)
        spark.catalog.refreshTable(table)


def _hot_keys(df: DataFrame, layout: Layout, known: DataFrame | None = None) -> DataFrame:
    """Keys to keep apart, written to the shared folder. At most rows / max_rows, and those known."""
    found = hot_keys(df, [*layout.parts, layout.key], layout.max_rows)
    keys = (df.where(F.lit(False)) if found is None else found).select(layout.key)
    keys = (keys if known is None else keys.union(known)).distinct()
    path = work_path(df.sparkSession, "hot-keys")
    keys.select(F.col(layout.key).alias("_hot")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _side(df: DataFrame, layout: Layout, hot: DataFrame, wanted: bool) -> DataFrame:
    same = F.col(layout.key).eqNullSafe(F.col("_hot"))
    return df.join(broadcast_if_small(hot), same, "left_semi" if wanted else "left_anti")


def _insert_hot(rows: DataFrame, layout: Layout) -> None:
    """Rows into the hot table, along (partition, key, date), some max_rows to a file at most."""
    spark = rows.sparkSession
    rows = rows.select(*spark.table(layout.hot).columns)
    count = rows.count()
    if not count:
        return
    order = [*layout.parts, layout.key, layout.date]
    # Bounds of ranges are estimates: half as many rows are aimed at.
    rows = rows.repartitionByRange(max(1, -(-2 * count // layout.max_rows)), *order).sortWithinPartitions(*order)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(layout.hot)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _drop_missing(spark: SparkSession, table: str, touched: list[Row], there: list[Row], parts: Sequence[str]) -> None:
    """Partitions that were replaced by nothing, which dynamic overwrite leaves as they were."""
    for row in set(map(tuple, touched)) - set(map(tuple, there)):
        spec = ", ".join(f"`{p}`={_literal(v)}" for p, v in zip(parts, row))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
