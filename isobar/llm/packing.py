"""Packing documents into sequences of a fixed length by non-negative least squares.

A document is cut into full sequences and one shorter rest. The histogram of rests
(one bin per length) is all the plan depends on: combinations of up to three lengths
that fill a window exactly are enumerated, the non-negative least squares problem
"repeat counts × combinations = histogram" is solved, counts are rounded down, and
what is left is packed greedily, longest first; a gap that no rest fits is filled by
cutting one. The last, partly filled sequence is cut into powers of two, which need
no padding. The plan says for ranges of rank within a length where rests go, so that
a Spark task can place each document by its rank alone.

Rests of one length may be a third of all documents (a group of copies): ranks are
taken within (length, bucket of the identifier's hash) and offset by the counts of
the buckets before. Histogram and plan are bounded by lengths × buckets, whatever
the number of documents.

Defined results: a null or empty text is its end id alone; repeated identifiers are
separate documents; an empty table gives no pieces; columns besides the two named
are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import arrow_map, id_and_text, spread, stage
from isobar.llm.tokens import byte_encoder

BUCKETS = 64
# Combinations in the least squares problem per length; the problem stays a few thousand wide.
PER_LENGTH = 6


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Of one, two or three present lengths that sum up to the window, the most frequent partners first."""
    present = set(lengths.tolist())
    often = lengths[np.argsort(-counts, kind="stable")].tolist()
    found = {(window,)} if window in present else set()
    for a in lengths.tolist():
        if window - a in present:
            found.add(tuple(sorted((a, window - a))))
        left = PER_LENGTH
        for b in often:
            c = window - a - b
            if c in present and left:
                found.add(tuple(sorted((a, b, c))))
                left -= 1
    return sorted(found)


def nnls(uses: list[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x ≥ 0 with least |A x - counts|, by accelerated projected gradients.

    A has a row per length and a column per combination, at most three entries each.
    """
    place = {v: i for i, v in enumerate(lengths.tolist())}
    rows = np.array([place[v] for use in uses for v in use], np.int64)
    cols = np.array([j for j, use in enumerate(uses) for _ in use], np.int64)
    n, m = len(lengths), len(uses)

    def forward(x):
        return np.bincount(rows, weights=x[cols], minlength=n)

    def back(y):
        return np.bincount(cols, weights=y[rows], minlength=m)

    probe = np.ones(m)
    for _ in range(20):  # the largest eigenvalue bounds the step
        probe = back(forward(probe))
        probe /= np.linalg.norm(probe)
    step = 1.0 / (1.05 * np.linalg.norm(back(forward(probe))))
    x = z = np.zeros(m)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, z - step * back(forward(z) - counts))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


class _Plan:
    """Takes ranks of lengths and puts them into sequences; `placed` is the plan."""

    def __init__(self, histogram: dict[int, int]):
        # Length → runs (first rank, count, source length, offset in the source).
        self.supply = defaultdict(list)
        for length, count in sorted(histogram.items()):
            if count:
                self.supply[length].append((0, count, length, 0))
        self.left = {k: v for k, v in histogram.items() if v}
        self.sequences = 0
        self.placed: list[tuple[int, int, int, int, int, int, int]] = []

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        runs, got = self.supply[length], []
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
        while count:
            first, have, source, skip = runs.pop()
            used = min(have, count)
            got.append((first, used, source, skip))
            if have > used:
                runs.append((first + used, have - used, source, skip))
            count -= used
        return got

    def put(self, runs, part: int, sequence: int, offset: int) -> None:
        """Consecutive sequences take one piece of `part` ids of each rank of the runs."""
        for first, count, source, skip in runs:
            self.placed.append((source, first, first + count, skip, part, sequence, offset))
            sequence += count

    def give(self, length: int, runs) -> None:
        for run in runs:
            self.supply[length].append(run)
            self.left[length] = self.left.get(length, 0) + run[1]

    def repeat(self, use: tuple[int, ...], times: int) -> None:
        offset = 0
        for length in use:
            self.put(self.take(length, times), length, self.sequences, offset)
            offset += length
        self.sequences += times


def plan(histogram: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int, int, int]], int]:
    """((source length, first rank, end rank, skip, ids, first sequence, offset), ...), number of sequences.

    Rank r of a source in [first, end) puts `ids` ids from `skip` on into sequence
    first sequence + r - first, at offset.
    """
    p = _Plan(histogram)
    if p.left:
        lengths = np.array(sorted(p.left), np.int64)
        counts = np.array([p.left[v] for v in lengths.tolist()], float)
        uses = combinations(lengths, counts, window)
        if uses:
            for use, x in zip(uses, np.floor(nnls(uses, lengths, counts) + 1e-6).astype(int).tolist()):
                times = min([x, *(p.left.get(v, 0) // use.count(v) for v in use)])
                if times > 0:
                    p.repeat(use, times)
    while p.left:
        # Longest first, then the longest that fits; as many such sequences as the rests allow.
        use, room = [], window
        have = dict(p.left)
        while room:
            fit = max((v for v in have if v <= room), default=0)
            if not fit:
                break
            use.append(fit)
            room -= fit
            have[fit] -= 1
            if not have[fit]:
                del have[fit]
        times = min(p.left[v] // use.count(v) for v in use)
        if room and have:
            # No rest fits the gap: the shortest of the others is cut.
            cut = min(have)
            times = max(1, min(times, p.left[cut] // (use.count(cut) + 1)))
        start = p.sequences
        if not room or have:
            p.repeat(tuple(use), times)
            if room:
                runs = p.take(cut, times)
                p.put([(f, n, s, k) for f, n, s, k in runs], room, start, window - room)
                p.give(cut - room, [(f, n, s, k + room) for f, n, s, k in runs])
            continue
        _last(p, use, window)
    return p.placed, p.sequences


def _last(p: _Plan, use: list[int], window: int) -> None:
    """All that is left fits one sequence: sequences of powers of two, none padded."""
    total = sum(use)
    sizes = [1 << b for b in range(window.bit_length() - 1, -1, -1) if total >> b & 1]
    room = sizes.pop(0)
    offset, sequence = 0, p.sequences
    for length in use:
        for first, count, source, skip in p.take(length, 1):
            while length:
                part = min(length, room)
                p.placed.append((source, first, first + count, skip, part, sequence, offset))
                skip, length, room, offset = skip + part, length - part, room - part, offset + part
                if not room and sizes:
                    room, offset, sequence = sizes.pop(0), 0, sequence + 1
    p.sequences = sequence + 1


def encoded(
    docs: DataFrame, tokenizer_path: str, end_id: int, window: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents as ids, written once: doc_id, tokens, rest, bucket, full, ids (2 or 4 bytes each)."""

    def encode(batches):
        enc = byte_encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            ids = [x + end for x in enc.column(b.column(1))]
            yield {
                "doc_id": b.column(0).to_pylist(), "tokens": [len(x) // len(end) for x in ids],
                "width": [len(end)] * len(ids), "ids": ids,
            }

    made = arrow_map(id_and_text(docs, id_col, text_col), encode, "doc_id long, tokens int, width int, ids binary")
    return stage(
        made.select(
            "*", (F.col("tokens") % window).alias("rest"), (F.col("tokens") / window).cast("int").alias("full"),
            spread("doc_id", parts=BUCKETS).alias("bucket"),
        ),
        "packing",
    )


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset."""
    docs = encoded(docs, tokenizer_path, end_id, window, id_col, text_col)
    # At most window × BUCKETS rows come to the driver.
    counts = docs.groupBy("rest", "bucket").agg(F.count("*").alias("n"), F.sum("full").alias("full")).collect()
    histogram: dict[int, int] = defaultdict(int)
    rank_from: dict[tuple[int, int], int] = {}
    full_from: dict[tuple[int, int], int] = {}
    full = 0
    for row in sorted(counts, key=lambda r: (r["rest"], r["bucket"])):
        key = (row["rest"], row["bucket"])
        rank_from[key], full_from[key] = histogram[row["rest"]], full
        histogram[row["rest"]] += row["n"]
        full += row["full"]
    histogram.pop(0, None)
    placed, _ = plan(histogram, window)
    by_source = defaultdict(list)
    for source, first, end, skip, ids, sequence, offset in placed:
        by_source[source].append((first, end, skip, ids, sequence - first, offset))
    # Runs of one source by the first rank of each cut, so that a rank is found by bisection.
    runs = {k: _indexed(v) for k, v in by_source.items()}
    state = docs.sparkSession.sparkContext.broadcast((rank_from, full_from, full, runs))

    def place(batches):
        rank_from, full_from, full_total, runs = state.value
        key, rank, sequence = None, 0, 0
        for b in batches:
            out = defaultdict(list)
            for doc_id, tokens, width, ids, rest, doc_full, bucket in zip(*(
                b.column(c).to_pylist() for c in ("doc_id", "tokens", "width", "ids", "rest", "full", "bucket")
            )):
                if (rest, bucket) != key:
                    key = (rest, bucket)
                    rank, sequence = rank_from[key], full_from[key]
                x = np.frombuffer(ids, f"<u{width}").astype("<u4")
                pieces = [(i * window, window, sequence + i, 0) for i in range(doc_full)]
                if rest:
                    cuts, groups = runs[rest]
                    group = groups[int(np.searchsorted(cuts, rank, "right")) - 1]
                    pieces += [
                        (doc_full * window + skip, n, full_total + base + rank, offset)
                        for skip, n, base, offset in group
                    ]
                for start, n, to, offset in pieces:
                    part = x[start : start + n].tobytes()
                    for name, v in (
                        ("doc_id", doc_id), ("start", start), ("length", n), ("ids", part),
                        ("ids_crc32", zlib.crc32(part)), ("doc_tokens", tokens), ("sequence_id", to), ("offset", offset),
                    ):
                        out[name].append(v)
                rank += 1
                sequence += doc_full
            if out:
                yield out

    ordered = docs.repartition("rest", "bucket").sortWithinPartitions("rest", "bucket", "doc_id", F.crc32("ids"))
    return arrow_map(
        ordered, place,
        "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def _indexed(runs: list[tuple[int, int, int, int, int, int]]):
    """Cuts of the rank axis, and for each stretch between cuts the pieces its ranks give."""
    cuts = sorted({x for first, end, *_ in runs for x in (first, end)})
    place = {c: i for i, c in enumerate(cuts)}
    groups: list[list] = [[] for _ in cuts]
    for first, end, skip, ids, base, offset in runs:
        for i in range(place[first], place[end]):
            groups[i].append((skip, ids, base, offset))
    return np.array(cuts, np.int64), groups
