"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A key's place on the ring is its hash, cut into BINS bins. Every shard owns
`vnodes` points; a key belongs to the next point clockwise. A shard takes its own
keys first and no more than its capacity; keys it has no room for go on clockwise,
turn by turn, until a shard takes them. With the default capacities, which add up
to the number of rows, counts differ by one at most.

Who takes which keys depends on how many rows each bin has, not on the rows: the
counts (BINS rows at most) come to the driver, which cuts every bin into ranges of
rank and gives each a shard and a first slot. Rows find their range by their rank
within the bin. Rows that repeat identifier and text are one row with a count until
the end, so no bin holds more than its share of different rows.

Defined results: a null text has no bytes; null identifiers share one key; an empty
table gives an empty result. Columns besides the two named are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections import defaultdict, deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 1 << 16
ROW_BYTES = 8


def points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(bin, shard) of all virtual nodes, clockwise."""

    def place(shard: int, i: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{shard}/{i}".encode()).digest()[:8], "big") % BINS

    return sorted((place(s, i), s) for s in range(shards) for i in range(vnodes))


def capacities(rows: int, shards: int, slack: float | None) -> list[int]:
    """Exact shares that differ by one at most, or the mean times `slack`, rounded up."""
    if slack is None:
        return [rows // shards + (i < rows % shards) for i in range(shards)]
    if slack < 1:
        raise ValueError("slack below 1 leaves rows without a shard")
    return [math.ceil(slack * rows / shards)] * shards


def ranges(counts: dict[int, int], shards: int, vnodes: int, slack: float | None = None) -> list[tuple[int, int, int, int, int]]:
    """(bin, first rank, end rank, shard, first slot) for bins with the given numbers of rows."""
    ring = points(shards, vnodes)
    bins = [b for b, _ in ring]
    room = capacities(sum(counts.values()), shards, slack)
    # Groups (bin, first, end) that wait at a point of the ring.
    waiting = defaultdict(deque)
    for b in sorted(counts):
        if counts[b]:
            waiting[bisect.bisect_left(bins, b) % len(ring)].append((b, 0, counts[b]))
    taken: list[tuple[int, int, int, int]] = []
    while waiting:
        onward = defaultdict(deque)
        for at in sorted(waiting):
            shard = ring[at][1]
            for b, first, end in waiting[at]:
                cut = first + min(end - first, room[shard])
                if cut > first:
                    taken.append((b, first, cut, shard))
                    room[shard] -= cut - first
                if cut < end:
                    onward[(at + 1) % len(ring)].append((b, cut, end))
        waiting = onward
    slots: dict[int, int] = defaultdict(int)
    out = []
    for b, first, end, shard in sorted(taken):
        out.append((b, first, end, shard, slots[shard]))
        slots[shard] += end - first
    return out


def assign(
    docs: DataFrame, shards: int, vnodes: int = 64, slack: float | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 48).cast("int")
    # crc32 and length take a null text for none.
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
        .withColumn("bin", place)
    )
    counted = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).groupBy(place.alias("bin")).count()
    counts = {r["bin"]: r["count"] for r in counted.collect()}
    cut = spark.createDataFrame(
        ranges(counts, shards, vnodes, slack), "bin int, first long, end long, shard int, first_slot long"
    )
    order = Window.partitionBy("bin").orderBy(F.xxhash64("doc_id"), "doc_id", "text_crc32", "size")
    upto = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumn("upto", upto).select(
        "doc_id", "size", "text_crc32", "bin",
        F.explode(F.sequence(F.col("upto") - F.col("copies"), F.col("upto") - 1)).alias("rank"),
    )
    # A row per bin and the few cuts within bins: bounded by BINS, not by the data.
    held = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    return (
        ranked.join(F.broadcast(cut), "bin")
        .where(held)
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot")
        )
    )
