"""Byte-level BPE by replaying the merges over all distinct words of the corpus.

Three steps, none of which sees a word twice where it can help it:

1. A task cuts a block of documents into pre-tokens and numbers the distinct ones. It
   writes each document as a list of numbers, and the words by buckets of their hash.
2. Words are exchanged by bucket, so that all copies of a word meet in one task. Their
   distinct ones are laid out in one row of linked symbols; an inverted index leads from
   each merge (the rank of the joined pair) to the places where it applies. Merges are applied
   in rank order, from the lowest, and each only updates its two neighbours and their
   entries. If joining two symbols makes a pair of lower rank than the one being applied, that one
   comes first, as it would within a single word.
3. Ids go back to their blocks, packed in the order of the words, and are gathered by the
   lists of numbers, which lie bucketed by block and are not sent again.

Blocks, the words replayed together and those remembered are bounded. Numbers of a block follow from
the partition that wrote it, and are written once before they are used.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated
rows are encoded alike; an empty table gives an empty result; ids that the
vocabulary lacks can't be decoded and raise. Columns besides the two named are not
read.
"""

from __future__ import annotations

import base64
import heapq
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from isobar.llm.base import arrow_map, id_and_text, spans
from isobar.llm.tokens import WordCache, byte_chunks
from isobar.session import work_path, work_table

BLOCK_CHARS = 10 << 20
#: Words a worker remembers, and those it replays together.
CHUNKS_KEPT = 300_000
WORDS_TOGETHER = 100_000
#: Bytes of text to a bucket of words, and the number of buckets at most: a block has a row for each.
BUCKET_BYTES = 16 << 20
BUCKETS = 4096
LIST_WORDS = 1 << 18
#: Of zstd.
LEVEL = 3
SHIFT = 20


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        bytes_of = {v: k for k, v in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.dtype = "<u2" if max(bytes_of) < 1 << 16 else "<u4"
        # All ways to join two symbols: a << SHIFT | b → rank of the join, which is its id.
        self.joins: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.joins[left << SHIFT | right] = rank
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.of_bytes = np.array(
            [[self.joins.get(int(x) << SHIFT | int(y), -1) for y in self.single] for x in self.single], np.int64
        )
        # The tokens' bytes behind each other, for decoding.
        self.length = np.array([len(bytes_of.get(i, b"")) for i in range(max(bytes_of) + 1)], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(len(self.length))), np.uint8)
        self.chunks = WordCache(self._chunks, limit=CHUNKS_KEPT)
        self.words = WordCache(self._words, limit=CHUNKS_KEPT)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        # All words behind each other; -1 ends a word.
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        size = int(ends[-1]) + 1 if len(words) else 0
        joined = np.frombuffer(b"\0".join(words) + b"\0" if words else b"", np.uint8)
        first = self.single[joined]
        first[ends if size else []] = -1
        rank_at = np.full(size, -1, np.int64)
        rank_at[:-1] = np.where((first[:-1] >= 0) & (first[1:] >= 0), self.of_bytes[joined[:-1], joined[1:]], -1)
        # The index: rank → places where the join applies, ascending.
        order = np.argsort(rank_at, kind="stable")
        order = order[np.searchsorted(rank_at[order], 0) :]
        cuts = np.flatnonzero(np.diff(rank_at[order])) + 1
        places = {int(rank_at[p[0]]): p.tolist() for p in np.split(order, cuts) if len(p)}
        symbol, after, before = first.tolist(), list(range(1, size + 1)), list(range(-1, size - 1))
        join = self.joins.get
        heap = sorted(places)
        while heap:
            rank = heapq.heappop(heap)
            todo = places.pop(rank, None)
            if todo is None:
                continue
            todo.sort()
            for n, i in enumerate(todo):
                a = symbol[i]
                j = after[i]
                if a < 0 or symbol[j] < 0 or join(a << SHIFT | symbol[j]) != rank:
                    continue
                symbol[i] = rank
                symbol[j] = -2
                k = after[i] = after[j]
                before[k] = i
                lower = False
                if symbol[k] >= 0:
                    new = join(rank << SHIFT | symbol[k])
                    if new is not None:
                        if new in places:
                            places[new].append(i)
                        else:
                            places[new] = [i]
                            heapq.heappush(heap, new)
                        lower = new < rank
                h = before[i]
                if h >= 0 and symbol[h] >= 0:
                    new = join(symbol[h] << SHIFT | rank)
                    if new is not None:
                        if new in places:
                            places[new].append(h)
                        else:
                            places[new] = [h]
                            heapq.heappush(heap, new)
                        lower = lower or new < rank
                if lower and n + 1 < len(todo):
                    # The lower pair comes first, then the rest of this merge.
                    places[rank] = todo[n + 1 :]
                    heapq.heappush(heap, rank)
                    break
        left = np.array(symbol, np.int64)
        left = left[left != -2]
        stops = np.flatnonzero(left == -1)
        begins = np.concatenate(([0], stops[:-1] + 1)) if len(stops) else stops
        flat = left.tolist()
        return [flat[x:y] for x, y in zip(begins.tolist(), stops.tolist())]

    def _words(self, words: list[bytes]) -> list[bytes]:
        code = f"<{{}}{'H' if self.dtype == '<u2' else 'I'}"
        return [struct.pack(code.format(len(x)), *x) for x in self.replay(words)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        split = [self.find(c) for c in chunks]
        words = list(dict.fromkeys(w for ws in split for w in ws))
        ids = dict(zip(words, self._words([w.encode() for w in words])))
        return [ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws]) for ws in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the new words of all texts are replayed together."""
        cut = [byte_chunks(t) if t else [] for t in texts]
        flat = self.chunks.get([c for cs in cut for c in cs])
        out, at = [], 0
        for cs in cut:
            out.append(np.frombuffer(b"".join(flat[at : at + len(cs)]), self.dtype))
            at += len(cs)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or not self.length[ids].all()):
            raise ValueError("ids that the vocabulary lacks")
        return self.flat[spans(self.begin[ids], self.length[ids])].tobytes()


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    """One codec per worker process, so that its words outlive a task."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBPE(path, pattern)
    return _CODECS[path, pattern]


def _blocks(batches):
    """(identifiers, texts) of about BLOCK_CHARS characters."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            ids.append(i)
            texts.append(t.as_py())
            size += len(texts[-1])
            if size >= BLOCK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _both(ids: list[np.ndarray], decoded: list[bytes]) -> dict[str, list]:
    return {"ids": ids, "decoded": decoded}


# Rows of a block: which bucket each number lies in; words or their ids by bucket; lists by place.
BUCKET_OF, WORDS, LISTS = 0, 1, 2
ROWS = "block long, kind int, place int, n int, words binary, lists binary, doc_ids array<long>, counts array<int>"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, the lowest bytes of all first: small numbers take little room."""
    planes = np.ascontiguousarray(np.asarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _row(block, kind, place, n=0, words=None, lists=None, doc_ids=None, counts=None) -> dict[str, list]:
    named = dict(block=block, kind=kind, place=place, n=n, words=words, lists=lists, doc_ids=doc_ids, counts=counts)
    return {k: [v] for k, v in named.items()}


def _numbered(block: int, ids: list, texts: list[str], find, buckets: int):
    """The rows of one block. Frequent words get small numbers, which take little room in lists."""
    number: dict[str, int] = {}
    known: dict[str, bytes] = {}
    held = []
    for text in texts:
        chunks = byte_chunks(text) if text else []
        for c in set(chunks).difference(known):
            words = find(c)
            known[c] = struct.pack(f"<{len(words)}I", *[number.setdefault(w, len(number)) for w in words])
        held.append(b"".join(map(known.__getitem__, chunks)))
    counts = [len(x) // 4 for x in held]
    numbers = np.frombuffer(b"".join(held), "<u4")
    order = np.argsort(-np.bincount(numbers, minlength=len(number)), kind="stable")
    words = [w.encode() for w in number]
    words = [words[i] for i in order.tolist()]
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    numbers = place[numbers]

    ends = np.cumsum(counts)
    first, at = 0, 0
    for n, last in enumerate(_groups(counts)):
        to = int(ends[last - 1])
        yield _row(block, LISTS, n, lists=_packed(numbers[at:to]), doc_ids=ids[first:last], counts=counts[first:last])
        first, at = last, to
    bucket_of = np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint32, len(words))
    yield _row(block, BUCKET_OF, 0, lists=_packed(bucket_of))
    order = np.argsort(bucket_of, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(bucket_of[order])) + 1):
        if len(some):
            mine = [words[i] for i in some.tolist()]
            yield _row(block, WORDS, int(bucket_of[some[0]]), len(mine), words=_joined(mine))


def _groups(counts: list[int]):
    """Where to end groups of documents of some LIST_WORDS words."""
    size = 0
    for k, n in enumerate(counts, 1):
        size += n
        if size >= LIST_WORDS or k == len(counts):
            yield k
            size = 0


def _joined(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.ZstdCompressor(level=LEVEL).compress(lengths.tobytes() + b"".join(words))


def _split(data: bytes, n: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64) + 4 * n
    return [raw[x:y] for x, y in zip([4 * n, *ends[:-1].tolist()], ends.tolist())]


def _replayed(bpe: ByteBPE, rows: list[tuple]):
    """Rows (block, bucket, n, words) with the ids of their words instead."""
    cut = [_split(words, n) for _, _, n, words in rows]
    ids = iter(bpe.words.get([w for ws in cut for w in ws]))
    for (block, bucket, n, _), ws in zip(rows, cut):
        yield _row(block, WORDS, bucket, n, words=_joined([next(ids) for _ in ws]))


class _Block:
    """The ids of all words of a block, by number."""

    def __init__(self, bucket_of: np.ndarray, parts: list[tuple[bytes, int]], dtype: str):
        raw = [zstandard.ZstdDecompressor().decompress(data) for data, _ in parts]
        lengths = [np.frombuffer(r, "<u4", n) for r, (_, n) in zip(raw, parts)]
        size = np.dtype(dtype).itemsize
        width = np.concatenate(lengths).astype(np.int64) // size if raw else np.zeros(0, np.int64)
        self.flat = np.frombuffer(b"".join(r[4 * n :] for r, (_, n) in zip(raw, parts)), dtype)
        if len(width) != len(bucket_of):
            raise RuntimeError("words of a block are missing")
        # Buckets ascend, and numbers within a bucket.
        order = np.argsort(bucket_of, kind="stable")
        self.length, self.begin = np.empty_like(width), np.empty_like(width)
        self.length[order] = width
        self.begin[order] = np.cumsum(width) - width

    def ids(self, numbers: np.ndarray, counts: list[int]) -> list[np.ndarray]:
        """Ids of documents with so many words each."""
        width = self.length[numbers]
        flat = self.flat[spans(self.begin[numbers], width)]
        ends = np.concatenate(([0], np.cumsum(width)))[np.cumsum(counts)]
        return np.split(flat, ends[:-1])


def _bucket_count(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(min(BUCKETS, max(8, size // BUCKET_BYTES)))


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    output: Callable[[list[np.ndarray], list[bytes]], dict[str, list]] = _both,
    schema: str = "ids array<int>, decoded binary",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id with the ids of every row of docs and the bytes they decode to.

    `output` turns both lists into other columns within the same task, `schema` names them.
    """
    texts = id_and_text(docs, id_col, text_col)
    buckets = _bucket_count(texts)

    def number(batches):
        find, part = regex.compile(pattern).findall, TaskContext.get().partitionId()
        for k, (ids, block) in enumerate(_blocks(batches)):
            yield from _numbered(part << 32 | k, ids, block, find, buckets)

    def replay(batches):
        bpe, held, size = codec(path, pattern), [], 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                held.append(row)
                size += row[2]
                if size >= WORDS_TOGETHER:
                    yield from _replayed(bpe, held)
                    held, size = [], 0
        yield from _replayed(bpe, held)

    def assemble(block, ids):
        """Documents of a block, from its lists and the ids of its words."""
        bpe, lists = codec(path, pattern), block.sort_by([("kind", "ascending"), ("place", "ascending")]).to_pylist()
        parts = ids.sort_by("place").select(["words", "n"]).to_pylist()
        words = _Block(_unpacked(lists[0]["lists"]), [(p["words"], p["n"]) for p in parts], bpe.dtype)
        out = []
        for row in lists[1:]:
            found = words.ids(_unpacked(row["lists"]), row["counts"])
            made = {"doc_id": row["doc_ids"], **output(found, [bpe.decode(x) for x in found])}
            out.append(pa.table({f.name: pa.array(made[f.name], f.type) for f in target}, schema=target))
        return pa.concat_tables(out)

    schema = f"doc_id long, {schema}"
    target = to_arrow_schema(_parse_datatype_string(schema))
    blocks = _written(arrow_map(texts, number, ROWS), max(8, buckets))
    words = blocks.where(F.col("kind") == WORDS).select("block", "place", "n", "words").repartition("place")
    ids = arrow_map(words, replay, ROWS).select("block", "place", "n", "words")
    lists = blocks.where(F.col("kind") != WORDS).select("block", "kind", "place", "lists", "doc_ids", "counts")
    return lists.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(assemble, schema)


def _written(rows: DataFrame, buckets: int) -> DataFrame:
    """A table in the shared folder, bucketed by block: lists are later read where they lie, by block."""
    name = work_table("replay_blocks")
    writer = rows.write.format("parquet").option("path", work_path(rows.sparkSession, "replay-blocks"))
    writer.bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    return rows.sparkSession.table(name)
