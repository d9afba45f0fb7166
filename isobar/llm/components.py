"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import stage


def components(links: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, label) for every node with a link; the label is the smallest node of its component.

    Each round hangs the larger neighbours of every node, then its smaller ones, on the
    smallest, and is written to the shared folder. Neighbourhoods are only reduced to
    their minimum and joined back, so a node with a third of all links is no group in
    one task. rows, where known, bounds the links. What a round reads is at most twice
    the links of the one before.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links", rows
    )
    n, state = edges.count(), None
    while True:
        edges = stage(_small_star(stage(_large_star(edges), "stars", 2 * n)), "stars", 2 * n)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        n, state = now[0], now
    # Every node now hangs on the smallest of its component.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hung.union(own).where("u > v").distinct()
