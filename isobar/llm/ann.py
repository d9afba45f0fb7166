"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to unit length, where the nearest by distance is the nearest by
cosine. Each of `tables` tables hashes a vector by `hashes` functions
floor((a·v + b) / width) with Gaussian a. A query visits its own bucket and perturbed
ones in the order of estimated success: perturbing the functions whose boundary lies
nearest comes first (the expected distances of sorted boundaries give one order of
perturbation sets for all queries). All vectors of the visited buckets are ranked by
their exact cosine.

How many buckets to visit is fitted on a sample of at most SAMPLE vectors: as few as
give RECALL of the true neighbours within the sample. Neighbours in the whole table
are nearer than in a sample, so recall there is higher.

Work is cut into cells (table, part of its buckets); a cell with many vectors is cut
into slices that each see all queries of the cell. Equal vectors are one class that
is indexed once and keeps its smallest k + 1 identifiers, all that a list of k can
need. A query that finds fewer than k candidates is compared with every vector, in
blocks.

Defined results: vectors that are null, zero, of another dimension than most, or
hold a null or non-finite component take no part, as queries or candidates; ties go
to the smaller identifier; rows that repeat identifier and vector count once; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.base import arrow_map, stage
from isobar.operators.skew import broadcast_if_small

SAMPLE = 16_384
SAMPLE_QUERIES = 128
RECALL = 0.95
CELL_ROWS = 32_768
PAIRS = 200_000


class Hashing:
    """Hash functions of all tables and the order in which buckets are visited."""

    def __init__(self, dim: int, tables: int = 12, hashes: int = 14, width: float = 2.5, probes: int = 64, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables, self.hashes, self.width = tables, hashes, width
        self.a = rng.normal(size=(tables, dim, hashes))
        self.b = rng.uniform(0, width, (tables, 1, hashes))
        self.mix = rng.integers(1, 1 << 62, (tables, hashes), dtype=np.int64) | 1
        self.visit(probes)

    def visit(self, probes: int) -> None:
        """Perturbation sets over the 2·hashes boundaries in the order of their distance."""
        m = self.hashes
        # Expected squared distances of the sorted boundaries.
        j = np.arange(1, 2 * m + 1)
        near = j * (j + 1) / (4 * (m + 1) * (m + 2))
        far = 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        cost = np.where(j <= m, near, far)
        self.sets = _cheapest_sets(cost, probes)
        self.probes = len(self.sets)

    def place(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        x = (unit @ self.a[table] + self.b[table]) / self.width
        whole = np.floor(x)
        return whole.astype(np.int64), x - whole

    def buckets(self, unit: np.ndarray, table: int) -> np.ndarray:
        return self.place(unit, table)[0] @ self.mix[table]

    def visited(self, unit: np.ndarray, table: int) -> np.ndarray:
        """A row of bucket keys per query, in the order of visiting."""
        whole, part = self.place(unit, table)
        m = self.hashes
        # Boundary i < m lies below function i, boundary m + i above it.
        order = np.argsort(np.concatenate([part, 1 - part], 1), axis=1, kind="stable")
        step = np.concatenate([-self.mix[table], self.mix[table]])[order]
        return (whole @ self.mix[table])[:, None] + step @ self.sets.T.astype(np.int64)


def _cheapest_sets(cost: np.ndarray, n: int) -> np.ndarray:
    """The n cheapest sets of positions as rows of 0/1; no set holds both j and its opposite."""
    import heapq

    size = len(cost)
    out = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < n:
        total, chosen = heapq.heappop(heap)
        # Position j and position size-1-j are the two boundaries of one function.
        if not any(size - 1 - j in chosen for j in chosen):
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < size:
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
    rows = np.zeros((len(out), size), np.int8)
    for i, chosen in enumerate(out):
        rows[i, list(chosen)] = 1
    return rows


def fit(sample: np.ndarray, k: int, recall: float = RECALL, **shape) -> tuple[Hashing, float]:
    """The index that visits as few buckets as reach the recall within the sample."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    index = Hashing(sample.shape[1], **shape)
    queries = unit[:SAMPLE_QUERIES]
    near = queries @ unit.T
    near[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    true = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(unit) - 1)]
    if not true.size:
        return index, 1.0
    keys = [index.buckets(unit, t) for t in range(index.tables)]
    probes = 64
    while True:
        index.visit(probes)
        hit = np.zeros(true.shape, bool)
        for t in range(index.tables):
            seen = index.visited(queries, t)
            wanted = keys[t][true]
            for i in range(len(queries)):
                hit[i] |= np.isin(wanted[i], seen[i])
        reached = float(hit.mean())
        if reached >= recall or index.probes < probes:
            return index, reached
        probes *= 2


def _best(q: np.ndarray, c: np.ndarray, s: np.ndarray, keep: int):
    """The `keep` best of every query: higher score, then smaller identifier; each candidate once."""
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    new = np.concatenate(([True], (q[1:] != q[:-1]) | (c[1:] != c[:-1])))
    q, c, s = q[new], c[new], s[new]
    starts = np.concatenate(([True], q[1:] != q[:-1]))
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(starts, np.arange(len(q)), 0))
    return q[rank < keep], c[rank < keep], s[rank < keep]


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _score_cells(cells: DataFrame, keep: int) -> DataFrame:
    """Rows (table, part, slice, is_query, id, keys, vector), a cell's vectors before its queries."""

    def run(batches):
        key, vectors, pending = None, None, []
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names}
            n = b.num_rows
            if not n:
                continue
            names = np.stack([cols[c].to_numpy() for c in ("table", "part", "slice", "is_query")], 1)
            edges = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), n]
            for lo, hi in zip(edges, edges[1:]):
                now = tuple(names[lo][:3])
                if now != key:
                    key, vectors, pending = now, None, []
                ids = cols["id"].slice(lo, hi - lo).to_numpy()
                unit = _matrix(cols["vector"].slice(lo, hi - lo))
                keys = cols["keys"].slice(lo, hi - lo)
                if not names[lo][3]:
                    pending.append((np.asarray(keys.flatten()), ids, unit))
                    continue
                if pending:
                    at, who, what = (np.concatenate(x) for x in zip(*pending))
                    order = np.argsort(at, kind="stable")
                    vectors, pending = (at[order], who[order], what[order]), []
                if vectors is None:
                    continue
                yield from _answers(vectors, ids, unit, keys)

    def _answers(vectors, ids, unit, keys):
        at, who, what = vectors
        norms = np.sqrt((what * what).sum(1))
        mine = np.sqrt((unit * unit).sum(1))
        counts = np.diff(keys.offsets.to_numpy())
        probe = keys.flatten().to_numpy()
        owner = np.repeat(np.arange(len(ids)), counts)
        lo, hi = np.searchsorted(at, probe, "left"), np.searchsorted(at, probe, "right")
        hit = hi > lo
        owner, lo, hi = owner[hit], lo[hit], hi[hit]
        ends = np.cumsum(hi - lo)
        start = 0
        while start < len(owner):
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            n = hi[start:stop] - lo[start:stop]
            q = np.repeat(owner[start:stop], n)
            v = np.repeat(lo[start:stop] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            score = np.einsum("ij,ij->i", unit[q], what[v]) / (mine[q] * norms[v])
            q, c, s = _best(ids[q], who[v], score, keep)
            yield {"query": q, "class": c, "score": s}
            start = stop

    return arrow_map(cells, run, "query long, class long, score double")


def search(
    vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which is_query holds."""
    spark = vectors.sparkSession
    keep = k + 1
    x = F.col(f"`{vector_col}`").cast("array<double>")
    ok = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(ok, F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), is_query.alias("asks"),
        F.transform(x, lambda v: v + F.lit(0.0)).alias("vector"),
    )
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stage(rows.where(F.size("vector") == sizes["dim"]).dropDuplicates(["id", "vector"]), "vectors")
    # Equal vectors: the smallest k + 1 identifiers, cut on the map side already.
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
    classes = stage(
        few.groupBy("vector").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("members")), "classes"
    )
    asking = stage(
        rows.where("asks").select(F.col("id").alias("query_id"), "vector")
        .join(classes.select("vector", F.col("id").alias("query")), "vector").select("query_id", "query"), "queries"
    )
    plain = classes.select("id", "vector")
    asked = asking.select(F.col("query").alias("id")).distinct().join(plain, "id")
    drawn = plain.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    index, _ = fit(np.array([r["vector"] for r in drawn]), k, recall)
    parts = max(1, math.ceil(classes.count() / (CELL_ROWS // 2)))
    hashing = spark.sparkContext.broadcast(index)

    def index_rows(batches):
        for b in batches:
            ids, found = b.column("id"), b.column("vector")
            unit = _matrix(found)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            for t in range(hashing.value.tables):
                keys = hashing.value.buckets(unit, t)
                yield {
                    "table": [t] * len(ids), "part": (keys % parts).astype(np.int32), "id": ids,
                    "keys": [[x] for x in keys.tolist()], "vector": found,
                }

    def query_rows(batches):
        for b in batches:
            unit = _matrix(b.column("vector"))
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            whole, ids = b.column("vector").to_pylist(), b.column("id").to_pylist()
            for t in range(hashing.value.tables):
                keys = hashing.value.visited(unit, t)
                out = {"table": [], "part": [], "id": [], "keys": [], "vector": []}
                for i, row in enumerate(keys):
                    to = row % parts
                    for part in np.unique(to).tolist():
                        for name, v in (
                            ("table", t), ("part", part), ("id", ids[i]), ("keys", row[to == part]), ("vector", whole[i])
                        ):
                            out[name].append(v)
                yield out

    schema = "table int, part int, id long, keys array<long>, vector array<double>"
    indexed = stage(arrow_map(plain, index_rows, schema), "index")
    slices = indexed.groupBy("table", "part").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("slices"))
    slices = broadcast_if_small(stage(slices, "cells"))
    top = stage(_ranked(_score_cells(_cells(indexed, arrow_map(asked, query_rows, schema), slices), keep), keep), "found")

    short = top.groupBy("query").count().where(F.col("count") < keep).select("query")
    short = asked.join(short, F.col("id") == F.col("query"), "left_semi")
    total = classes.limit(keep).count()
    if total >= keep and not short.isEmpty():
        # Every vector in one bucket of blocks, the whole of it compared with these queries.
        blocks = max(1, math.ceil(classes.count() / CELL_ROWS))
        one = [F.lit(-1).alias("table"), F.lit(0).alias("part"), "id", F.array(F.lit(0).cast("long")).alias("keys"), "vector"]
        all_cells = _cells(plain.select(*one), short.select(*one), F.broadcast(spark.createDataFrame([(-1, 0, blocks)], "table int, part int, slices int")))
        top = stage(_ranked(top.union(_score_cells(all_cells, keep)), keep), "exact")

    lists = top.join(classes.select(F.col("id").alias("class"), "members"), "class")
    lists = lists.select("query", "score", F.explode("members").alias("vec_id"))
    # Per query class the best k + 1 identifiers do for each of its queries.
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = lists.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)
    mine = lists.join(asking, "query").where(F.col("vec_id") != F.col("query_id"))
    per_query = Window.partitionBy("query_id").orderBy("n")
    return (
        mine.withColumn("rank", F.row_number().over(per_query).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cells(indexed: DataFrame, queries: DataFrame, slices: DataFrame) -> DataFrame:
    one = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
    kept = indexed.join(slices, ["table", "part"]).withColumn("slice", one).withColumn("is_query", F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    asked = queries.join(slices, ["table", "part"]).withColumn("slice", every).withColumn("is_query", F.lit(1))
    names = ["table", "part", "slice", "is_query", "id", "keys", "vector"]
    both = kept.select(*names).union(asked.select(*names))
    cell = ["table", "part", "slice"]
    return both.repartition(*cell).sortWithinPartitions(*cell, "is_query")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    once = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    return once.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep).drop("n")
