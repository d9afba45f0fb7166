"""Search, sharding, similarity join and components against brute force."""

import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import ann, base, jaccard, ring
from isobar.llm.components import components
from isobar.session import shared_dir


def grams(text, n=5):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_groups(rows, percent=80):
    """[(doc_id, n, component)] by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def groups_of(df, **more):
    return sorted((tuple(r) for r in jaccard.similar_groups(df, **more).collect()), key=repr)


def test_odd_rows(odd, none):
    assert groups_of(odd) == brute_groups([(r.doc_id, r.text) for r in odd.collect()])
    assert groups_of(none) == []
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, 6, 7, 7, None, 9, 10], key=repr)


def test_null_identifiers_are_linked(spark):
    """A near copy without an identifier, a bridge without one, groups without any, and a repeated one."""
    words = [[f"{g}x{i}" for i in range(200)] for g in "abcd"]
    near = lambda g, k: " ".join([f"new{g}{k}"] * k + words[g][k:])
    rows = [
        (5, near(0, 0)), (None, near(0, 8)), (None, near(0, 8)),
        (11, near(1, 0)), (None, near(1, 20)), (12, near(1, 40)),
        (None, near(2, 0)), (None, near(2, 8)), (None, near(2, 8).upper()),
        (20, near(3, 0)), (None, "alone and without a name"), (None, None),
    ]
    want = brute_groups(rows)
    assert [r[2] for r in want].count(5) == 3 and [r[2] for r in want].count(11) == 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert groups_of(df) == want
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=repr)
    assert kept == sorted(((k, t) for k, t in rows if k in (5, 11, 20) or k is None and (t, k) not in [(near(0, 8), k), (near(1, 20), k)]), key=repr)


@pytest.mark.parametrize("share", [0.3, 1.0])
def test_no_link_of_null_identifiers_is_lost(spark, share):
    rng = random.Random(6)
    rows = [(None if rng.random() < share else k, t) for k, t in near_copies(3, 250)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert groups_of(df) == brute_groups(rows)


def near_copies(seed, n):
    """Texts with groups of near copies of many degrees, a shared passage and common words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3_000)}"
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.choice([3, 5, 20, 60, 200]))] for _ in range(12)]
    rows = []
    for i in range(n):
        base = list(rng.choice(bases)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            if base:
                base[rng.randrange(len(base))] = word()
        if rng.random() < 0.3:
            base[rng.randrange(len(base) + 1) :] += passage
        rows.append((i, " ".join(base) if rng.random() < 0.9 else " ".join(base).upper()))
    return rows


@pytest.mark.parametrize("seed,chains", [(1, 2), (2, 0)])
def test_no_link_is_lost(spark, monkeypatch, seed, chains):
    monkeypatch.setattr(jaccard, "CHAINS", chains)
    rows = near_copies(seed, 350)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert groups_of(df) == brute_groups(rows)


def test_lists_in_slices_and_groups_in_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_ROWS", 7)
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(jaccard, "CELL_TOKENS", 300)
    rows = near_copies(4, 250)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert groups_of(df) == brute_groups(rows)


@pytest.fixture
def many_partitions(spark):
    """Forty shuffle partitions that stay forty; gives what was staged since: [(name, files)]."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    folder = Path(shared_dir(spark).removeprefix("file:")) / "isobar"
    old = set(folder.glob("*"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield lambda: [(d.name[:-33], len(list(d.glob("part-*")))) for d in folder.glob("*") if d not in old]
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_steps_go_into_few_files(spark, many_partitions):
    """A file a shuffle partition starts thousands of processes, each for a moment a copy of its executor."""
    rows = near_copies(7, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert groups_of(df) == brute_groups(rows)
    files = many_partitions()
    assert {"open", "frequencies", "adaptive", "pairs", "links", "stars", "labels", "members"} <= {k for k, _ in files}
    cores = spark.sparkContext.defaultParallelism
    assert [(k, n) for k, n in files if k not in ("prefixes", "sets") and n > cores] == []


def test_files_grow_with_rows(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(base, "FILE_ROWS", 50)
    df = spark.range(1_000).repartition(40, "id")
    for rows, files in ((None, 40), (1_000, 20), (0, spark.sparkContext.defaultParallelism), (10**6, 40)):
        assert base.stage(df, f"rows-{rows}", rows).count() == 1_000
        assert dict(many_partitions())[f"rows-{rows}"] == files


def test_prefix_lemma():
    rng = random.Random(0)
    for _ in range(2_000):
        x = set(rng.sample(range(60), rng.randrange(1, 50)))
        y = set(x)
        for _ in range(rng.randrange(8)):
            y ^= {rng.randrange(60)}
        both = len(x & y)
        if not y or 100 * both < 80 * len(x | y):
            continue
        for m in range(1, both + 1):
            px, py = (set(sorted(s)[: len(s) - jaccard.least_shared(len(s), 80) + m]) for s in (x, y))
            assert len(px & py) >= m


def test_short_form_round_trip():
    nodes = np.array([1, (1 << 40) - 1, 1 << 39, 0], np.int64)
    assert jaccard._unpacked(jaccard._packed(nodes)).tolist() == nodes.tolist()


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, query string, members int")


def test_search_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1_500, 16)).astype(np.float32)
    x[700:900] = x[3]  # one vector many times
    x[901] = x[5] * 3  # the same direction
    rows = [(i, v.tolist(), 0, "q", 1) for i, v in enumerate(x)]
    rows += [
        (2000, None, 0, "q", 1), (2050, [0.0] * 16, 0, "q", 1), (2100, [float("nan")] + [1.0] * 15, 0, "q", 1),
        (2150, [None] + [1.0] * 15, 0, "q", 1), (2200, [float("inf")] + [1.0] * 15, 0, "q", 1), (2250, [1.0, 2.0], 0, "q", 1),
        (None, [1.0] * 16, 0, "q", 1), rows[50],
    ]
    got = defaultdict(list)
    for r in ann.search(vectors_of(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    assert sorted(got) == list(range(0, 1_500, 50))
    for q, found in got.items():
        found.sort()
        score = unit @ unit[q]
        score[q] = -2
        best = np.lexsort((np.arange(len(x)), -np.round(score, 12)))[:5]
        assert [r for r, *_ in found] == [1, 2, 3, 4, 5] and q not in [v for _, v, _ in found]
        assert np.allclose([s for *_, s in found], score[[v for _, v, _ in found]], atol=1e-9)
        assert [(-round(s, 12), v) for _, v, s in found] == sorted((-round(s, 12), v) for _, v, s in found)
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
    assert hits >= 0.9 * 5 * len(got)
    assert [v for _, v, _ in sorted(got[750])] == [3, 700, 701, 702, 703]


@pytest.mark.parametrize("n", [0, 1, 4])
def test_search_of_few(spark, n):
    rows = [(i * 50, [1.0, float(i)], 0, "q", 1) for i in range(n)]
    got = ann.search(vectors_of(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert len(got) == n * max(0, n - 1)


def test_queries_short_of_candidates_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(ann, "fit", lambda sample, k, recall: (ann.Hashing(sample.shape[1], tables=1, probes=1), 0.0))
    monkeypatch.setattr(ann, "CELL_ROWS", 40)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 12))
    rows = [(i, v.tolist(), 0, "q", 1) for i, v in enumerate(x.astype(np.float32).astype(float))]
    got = ann.search(vectors_of(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert len(got) == 20


def test_probe_sets_come_in_order():
    index = ann.Hashing(8, tables=1, hashes=5, probes=200)
    sets = index.sets
    assert not sets[0].any() and len({r.tobytes() for r in sets}) == len(sets)
    assert not (sets & sets[:, ::-1]).any()


@pytest.mark.parametrize("slack", [None, 1.0, 1.3])
def test_ring_bounds_loads(slack):
    rng = random.Random(2)
    counts = {rng.randrange(ring.BINS): rng.randrange(1, 9) for _ in range(3_000)}
    counts[17] = 2_000
    got = ring.ranges(counts, 24, 64, slack)
    load, seen, slots = defaultdict(int), defaultdict(list), defaultdict(list)
    for b, first, end, shard, slot in got:
        load[shard] += end - first
        seen[b].append((first, end))
        slots[shard].append((slot, end - first))
    room = ring.capacities(sum(counts.values()), 24, slack)
    assert all(load[s] <= room[s] for s in range(24))
    for b, parts in seen.items():
        at = 0
        for first, end in sorted(parts):
            assert first == at
            at = end
        assert at == counts[b]
    for parts in slots.values():
        at = 0
        for slot, n in sorted(parts):
            assert slot == at
            at += n


def test_ring_moves_little():
    rng = random.Random(8)
    counts = {b: rng.randrange(1, 4) for b in rng.sample(range(ring.BINS), 20_000)}

    def where(shards):
        return {(b, k): s for b, first, end, s, _ in ring.ranges(counts, shards, 64, 1.25) for k in range(first, end)}

    before, after = where(24), where(25)
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.15 * len(before)


def test_ring_against_walk(spark):
    """Each key walks the ring by itself, in the order of the operator's turns."""
    counts = {5: 4, 9: 1, 40_000: 3, 65_535: 2}
    points = ring.points(3, 2)
    got = ring.ranges(counts, 3, 2)
    room = ring.capacities(10, 3, None)
    at = {}
    for b in counts:
        after = [i for i, (p, _) in enumerate(points) if p >= b]
        at[b] = after[0] if after else 0
    keys = sorted((b, k) for b, c in counts.items() for k in range(c))
    where, step = {}, 0
    while len(where) < 10:
        for pos in range(len(points)):
            for key in keys:
                if key not in where and (at[key[0]] + step) % len(points) == pos and room[points[pos][1]]:
                    room[points[pos][1]] -= 1
                    where[key] = points[pos][1]
        step += 1
    assert {(b, k): s for b, first, end, s, _ in got for k in range(first, end)} == where


def test_ring_rows(odd, none):
    rows = ring.assign(odd, 4).collect()
    want = sorted((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in odd.collect() if r.doc_id)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(len(s) for s in slots.values()) == [2, 3, 3, 3]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert ring.assign(none, 4).count() == 0
