"""Exact deduplication by Patricia tries.

Texts are equal when they are after lower-casing A to Z. Full normalised bytes go to
the partition of their (length, content hash) and into a compressed radix trie
there; a terminal node holds the identifier that owns the text, how many rows it
has and its digest. Map tasks insert into bounded tries of their own first, so a
text held by a third of all rows reaches its partition once per task.

A trie over its memory limit spills by subtree: the heaviest subtree below the
root goes to a file in the task's temporary folder, later keys of that subtree
follow it there, and the file is treated the same way afterwards, cut where its
keys first differ.

Defined results: a null text counts as empty; a null identifier loses to any other;
of rows with equal text and equal identifier one is kept; an empty table gives an
empty result. Columns besides the two named are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import arrow_append, arrow_map, id_and_text

MAP_TRIE_BYTES = 32 << 20
REDUCE_TRIE_BYTES = 96 << 20
_NODE_BYTES = 400


class _Node:
    __slots__ = ("label", "children", "entry")

    def __init__(self, label: bytes):
        self.label, self.children, self.entry = label, {}, None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of a and b[at:], by bisection over memory compares."""
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo : at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Byte strings → [owner, rows, digest]; the owner is the least identifier under `rank`."""

    def __init__(self, rank):
        self.root, self.rank, self.bytes, self.weight = _Node(b""), rank, 0, {}

    def insert(self, key: bytes, owner, rows: int, digest: bytes) -> None:
        node, at, n, before = self.root, 0, len(key), self.bytes
        while at < n:
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                self.bytes += n - at + _NODE_BYTES
                node, at = child, n
            elif key.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                k = _shared(child.label, key, at)
                mid = node.children[key[at]] = _Node(child.label[:k])
                child.label = child.label[k:]
                mid.children[child.label[0]] = child
                self.bytes += _NODE_BYTES
                node, at = mid, at + k
        if node.entry is None:
            node.entry = [owner, rows, digest]
        else:
            node.entry[1] += rows
            if self.rank(owner) < self.rank(node.entry[0]):
                node.entry[0] = owner
        if n and self.bytes > before:
            self.weight[key[0]] = self.weight.get(key[0], 0) + self.bytes - before

    def items(self, start: _Node | None = None, prefix: bytes = b""):
        stack = [(start or self.root, prefix)]
        while stack:
            node, key = stack.pop()
            key += node.label
            if node.entry is not None:
                yield key, *node.entry
            stack.extend((c, key) for c in node.children.values())

    def cut(self, first: int):
        """Take the subtree below the root that starts with a byte out of memory."""
        node = self.root.children.pop(first)
        self.bytes -= self.weight.pop(first)
        return self.items(node)


def owners_of(records, rank, limit: int):
    """Entries (owner, rows, digest) of all distinct keys, in bounded memory.

    `records` gives (key, owner, rows, digest).
    """
    with tempfile.TemporaryDirectory() as folder:
        pending = [(iter(records), 0)]
        while pending:
            source, skip = pending.pop()
            trie, files, shared = PatriciaTrie(rank), {}, {}

            def put(first: int, rest: bytes, record) -> None:
                old = shared.get(first)
                shared[first] = rest if old is None else old[: _shared(old, rest, 0)]
                pickle.dump(record, files[first])

            for key, owner, rows, digest in source:
                rest = key[skip:]
                if rest and rest[0] in files:
                    put(rest[0], rest, (key, owner, rows, digest))
                    continue
                trie.insert(rest, owner, rows, digest)
                while trie.bytes > limit and trie.weight:
                    first = max(trie.weight, key=trie.weight.get)
                    files[first] = tempfile.TemporaryFile(dir=folder)
                    # What all keys of this file share so far is not kept with them.
                    head = key[:skip]
                    for k, *entry in trie.cut(first):
                        put(first, k, (head + k, *entry))
            for _, owner, rows, digest in trie.items():
                yield owner, rows, digest
            for first, file in files.items():
                pending.append((_read(file), skip + len(shared[first])))


def _read(file):
    with file:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                break


def _rank(keep: str):
    if keep == "largest":
        return lambda x: (x is None, 0 if x is None else -x)
    if keep == "smallest":
        return lambda x: (x is None, x or 0)
    raise ValueError("keep is 'smallest' or 'largest'")


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per distinct text: digest (binary sha-256), keep_id, group_size."""
    rank = _rank(keep)

    def combine(batches):
        trie = PatriciaTrie(rank)

        def flush():
            found = list(trie.items())
            return {
                "length": [len(k) for k, *_ in found],
                "content": [int.from_bytes(d[:8], "little", signed=True) for *_, d in found],
                "text": [k for k, *_ in found],
                "owner": [o for _, o, _, _ in found],
                "rows": [r for _, _, r, _ in found],
                "digest": [d for *_, d in found],
            }

        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                key = (text.as_buffer().to_pybytes() if len(text.as_buffer()) else b"").lower()
                trie.insert(key, ident, 1, hashlib.sha256(key).digest())
                if trie.bytes > MAP_TRIE_BYTES:
                    yield flush()
                    trie = PatriciaTrie(rank)
        yield flush()

    def reduce(batches):
        def records():
            for b in batches:
                texts = b.column("text")
                for i, (o, r, d) in enumerate(zip(*(b.column(c).to_pylist() for c in ("owner", "rows", "digest")))):
                    yield texts[i].as_py(), o, r, d

        out = []
        for entry in owners_of(records(), rank, REDUCE_TRIE_BYTES):
            out.append(entry)
            if len(out) == 10_000:
                yield _columns(out)
                out = []
        yield _columns(out)

    def _columns(found):
        return {"keep_id": [x[0] for x in found], "group_size": [x[1] for x in found], "digest": [x[2] for x in found]}

    parts = arrow_map(
        id_and_text(docs, id_col, text_col), combine,
        "length long, content long, text binary, owner long, rows long, digest binary",
    )
    return arrow_map(
        parts.repartition("length", "content"), reduce, "digest binary, keep_id long, group_size long"
    )


def digests(docs: DataFrame, text_col: str = "text", name: str = "digest") -> DataFrame:
    """All columns of a frame and the digest of its normalised text."""

    def digest(texts):
        return {name: [hashlib.sha256(t.encode().lower()).digest() for t in texts]}

    return arrow_append(docs, text_col, digest, f"`{name}` binary")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    mine = digests(id_and_text(docs, id_col, text_col)).groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    found = mine.join(owners(docs, id_col, text_col, keep), "digest")
    return found.select(
        "doc_id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with the columns of docs."""
    held = owners(docs, id_col, text_col, keep).select(
        F.col("digest").alias("_owner_digest"), F.col("keep_id").alias("_owner_id")
    )
    rows = digests(docs, text_col, "_digest")
    same = (F.col("_digest") == F.col("_owner_digest")) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_owner_id"))
    # Rows that repeat identifier and text together are told apart by nothing: any one stays.
    kept = rows.join(held, same, "left_semi").dropDuplicates(["_digest"])
    return kept.select(*[f"`{c}`" for c in docs.columns])
