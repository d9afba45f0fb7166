"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of hashes of its word n-grams. Put all sets in one global order
of tokens; if two sets x, y have similarity of t or more, they share at least
a = ceil(t·max(|x|, |y|)) tokens, and the first l of those lie within the first
|x| - ceil(t·|x|) + l tokens of x, and likewise of y: their l-prefixes share l tokens,
for every l up to a. A longer prefix asks for more shared tokens.

1. Copies (equal sets) become one node. In hash order, each node's prefix for
   l = n/10 goes into per-bucket lists, map tasks sending each token once however
   many of their documents hold it. A node with fewer prefix tokens shared by others
   than l has no partner and is done with; that settles most documents.
2. The others' tokens are ordered by document frequency, rarest first. Each document
   lengthens its prefix to the l with the least estimated cost: entries read in the
   lists of its prefix tokens, plus verification of at most (entries / l) candidates.
3. Within each token's list, every node is verified first against the list's hub, then
   against a neighbour in mixed order, and what links is joined to components. Then all
   pairs of a list that lie in different components, fit in size and in the number of
   tokens they share with anyone, and share min(l_x, l_y) prefix tokens are verified on
   the whole sets, within tasks that hold blocks of nodes. Pairs within one component are
   not looked at: of a dense group, links that connect it suffice. No link between
   components is lost.

Hashes have 64 bits; two different n-grams of one comparison collide with a
probability below 10^-12.

Defined results: texts are lower-cased A to Z and cut at ASCII white space; fewer
than n words count as one n-gram; a null text or one without words has an empty set
and no link; rows that repeat an identifier are rows of their own; a component whose
identifiers are all null has none; an empty table gives an empty result. Columns
besides the two named are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.base import arrow_map, id_and_text, stage
from isobar.llm.components import components
from isobar.llm.tokens import WordCache
from isobar.operators.skew import broadcast_if_small

CHUNK_TOKENS = 1 << 20
SHORT = (1 << 40) - 1
# What verifying a candidate costs, in list entries read.
VERIFY = 50
# Lists longer than this are chained in slices.
LIST_ROWS = 100_000
CHAINS = 2
# Tokens of a block of nodes that are compared across components.
CELL_TOKENS = 1 << 22

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingles(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = max(1, len(h) - n + 1)
    width = min(n, len(h))
    out = np.full(size, np.uint64(width))
    for k in range(width):
        out ^= out >> np.uint64(29)
        out *= _C[k % 3]
        out += h[k : k + size]
    for c in _C[1:]:
        out ^= out >> np.uint64(30)
        out *= c
    return np.unique(out ^ (out >> np.uint64(31)))


def least_shared(n: int, percent: int) -> int:
    """Tokens a set of n shares with any partner."""
    return -(-percent * n // 100)


def first_matches(n: int) -> int:
    """Shared prefix tokens asked for in the first step."""
    return max(1, -(-n // 10))


def _first_step(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """docs: doc_id, text, ref. kind 0: a row per document; kind 1: (token, node) lists by bucket; kind 2: counts known already."""

    def run(batches):
        WordCache.forget()  # hashing a word takes less than looking it up
        held: list[tuple[int, np.ndarray]] = []
        seen: set[int] = set()
        size = 0

        def flush():
            tokens = np.concatenate([t for _, t in held])
            owner = np.repeat(np.array([k for k, _ in held], np.int64), [len(t) for _, t in held])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            count = np.diff(np.append(starts, len(tokens)))
            # A token of several documents here is known to be shared: counted here, sent once, without an owner.
            shared = np.repeat(count > 1, count)
            keys, times = np.unique(owner[shared], return_counts=True)
            sent, whose = tokens[starts], np.where(count > 1, 0, owner[starts])
            to = (sent % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            sent, whose, to = sent[order], whose[order], to[order]
            cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            ends = np.append(cuts[1:], len(to))
            m = len(cuts)
            yield {
                "kind": [1] * m, "doc_id": [None] * m, "ref": [None] * m, "n": [None] * m, "node": [None] * m, "bucket": to[cuts],
                "tokens": [(sent[a:b] >> np.uint64(32)).astype("<u4").tobytes() for a, b in zip(cuts, ends)],
                "nodes": [_packed(whose[a:b]) for a, b in zip(cuts, ends)],
            }
            if len(keys):
                yield {
                    "kind": [2], "doc_id": [None], "ref": [None], "n": [None], "node": [None], "bucket": [None],
                    "tokens": [times.astype(np.int64).tobytes()], "nodes": [keys.tobytes()],
                }

        for b in batches:
            sizes, nodes = [], []
            for text in b.column(1):
                s = shingles(text.as_py(), n)
                node = _node(s)
                sizes.append(len(s))
                nodes.append(node)
                if len(s) and node not in seen:
                    seen.add(node)
                    prefix = s[: len(s) - least_shared(len(s), percent) + first_matches(len(s))]
                    held.append((node & SHORT, prefix))
                    size += len(prefix)
                    if size >= CHUNK_TOKENS:
                        yield from flush()
                        held, seen, size = [], set(), 0
            none = [None] * len(sizes)
            yield {
                "kind": [0] * len(sizes), "doc_id": b.column(0), "ref": b.column(2), "n": sizes, "node": nodes,
                "bucket": none, "tokens": none, "nodes": none,
            }
        if held:
            yield from flush()

    return arrow_map(docs, run, "kind int, doc_id long, ref long, n long, node long, bucket int, tokens binary, nodes binary")


def _packed(nodes: np.ndarray) -> bytes:
    """40 bits of each node: all low halves, then all high bytes."""
    return (nodes & 0xFFFFFFFF).astype("<u4").tobytes() + (nodes >> 32).astype(np.uint8).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, "<u4", n).astype(np.int64) | np.frombuffer(data, np.uint8, n, 4 * n).astype(np.int64) << 32


def _node(tokens: np.ndarray) -> int | None:
    """Identity of a set: 64 bits of a digest, the short form never 0; none for the empty set."""
    if not len(tokens):
        return None
    node = int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
    return node if node & SHORT else node + 1


def _shared_counts(first: DataFrame) -> DataFrame:
    """(short, shared): how many prefix tokens of a node another node has too, or more than that.

    Lists hold 32 bits of each token beside its bucket, and 40 bits of each node. Tokens
    taken for one only raise counts; two partners taken for one node, which would lower
    them, have a probability of 10^-12.
    """

    def count(parts):
        tokens = np.concatenate([np.frombuffer(t, "<u4") for t, _ in parts])
        nodes = np.concatenate([_unpacked(k) for _, k in parts])
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])))
        tokens, nodes = tokens[new], nodes[new]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        size = np.diff(np.append(starts, len(tokens)))
        hit = nodes[np.repeat(size > 1, size)]
        return np.unique(hit[hit != 0], return_counts=True)

    def run(batches):
        parts, at = [], None
        for b in batches:
            for bucket, t, k in zip(*(b.column(c).to_pylist() for c in ("bucket", "tokens", "nodes"))):
                if bucket != at and parts:
                    keys, times = count(parts)
                    yield {"short": keys, "shared": times}
                    parts = []
                at = bucket
                parts.append((t, k))
        if parts:
            keys, times = count(parts)
            yield {"short": keys, "shared": times}

    def unpack(batches):
        for b in batches:
            for t, k in zip(b.column("tokens").to_pylist(), b.column("nodes").to_pylist()):
                yield {"short": np.frombuffer(k, np.int64), "shared": np.frombuffer(t, np.int64)}

    lists = first.where("kind = 1").select("bucket", "tokens", "nodes").repartition("bucket").sortWithinPartitions("bucket")
    known = first.where("kind = 2").select("tokens", "nodes")
    both = arrow_map(lists, run, "short long, shared long").union(arrow_map(known, unpack, "short long, shared long"))
    return both.groupBy("short").agg(F.sum("shared").alias("shared"))


def _prefixes(sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """(node, n, matches, shared, prefix, df): the prefix of every node by rising document frequency.

    `shared` counts the node's tokens that any other has; no overlap exceeds it. rows: tokens of all sets.
    """
    tokens = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = stage(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "frequencies", rows)
    ordered = (
        tokens.join(often, "token")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_set(F.struct("df", "token"))).alias("by_df"))
        .select("node", "n", F.col("by_df.df").alias("df"), F.col("by_df.token").alias("tokens"))
    )

    def run(batches):
        for b in batches:
            out = {"node": [], "n": [], "matches": [], "shared": [], "prefix": [], "df": []}
            for node, n, df, found in zip(*(b.column(c).to_pylist() for c in ("node", "n", "df", "tokens"))):
                need = least_shared(n, percent)
                # Any l up to what the smallest possible partner shares.
                limit = least_shared(need, percent)
                matches = np.arange(1, limit + 1)
                # Tokens of one document alone come first in the order and are no part of any list.
                kept = n - need + matches - (n - len(found))
                if (kept < matches).any():
                    continue
                read = np.cumsum(np.array(df, np.float64) - 1)[np.minimum(kept, len(found)) - 1]
                best = int(np.argmin(read + VERIFY * read / matches))
                m = int(kept[best])
                for name, v in (
                    ("node", node), ("n", n), ("matches", best + 1), ("shared", len(found)),
                    ("prefix", found[:m]), ("df", df[:m]),
                ):
                    out[name].append(v)
            yield out

    return arrow_map(
        ordered, run, "node long, n long, matches int, shared long, prefix array<long>, df array<long>"
    )


def _lists(prefixes: DataFrame) -> DataFrame:
    """A row per node and prefix token."""
    both = F.explode(F.arrays_zip("prefix", "df"))
    return prefixes.select("node", "n", "shared", "comp", both.alias("_at")).select(
        "node", "n", "shared", "comp", F.col("_at.prefix").alias("token"), F.col("_at.df").alias("df")
    )


def _fits(percent: int) -> Column:
    """Whether sizes, and tokens shared with anyone, allow a node and the `other_` one the similarity."""
    n, m = F.col("n"), F.col("other_n")
    sizes = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    return sizes & (F.least("shared", "other_shared") * (100 + percent) >= (n + m) * percent)


def _chained(prefixes: DataFrame, turn: int, percent: int) -> DataFrame:
    """Few pairs of every list that probably are links.

    In turn 0 each node goes with the list's hub, the one with the fewest tokens of its
    own: in a group of near copies that is the copy nearest to what they have in common.
    Afterwards each goes with its neighbour in a mixed order.
    """
    slice_ = F.pmod(F.xxhash64("node"), F.ceil(F.col("df") / LIST_ROWS))
    by = [F.col("n") - F.col("shared"), F.col("n")] if turn == 0 else [F.xxhash64(F.lit(turn), "node")]
    order = Window.partitionBy("token", "slice").orderBy(*by, "node")
    if turn == 0:
        order = order.rowsBetween(Window.unboundedPreceding, 0)
    pick = F.first if turn == 0 else F.lag
    names = ("node", "n", "shared", "comp")
    found = _lists(prefixes).withColumn("slice", slice_).select(
        *names, *(pick(c).over(order).alias(f"other_{c}") for c in names)
    )
    found = found.where((F.col("comp") != F.col("other_comp")) & _fits(percent))
    return found.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()


def _across(prefixes: DataFrame, sets: DataFrame, percent: int, entries: int) -> DataFrame:
    """Links between nodes of different components; for each two components one will do.

    Lists that lie in several components are brought together under their hub, so that
    a node comes once with all the lists of a group. A group is cut into blocks of
    CELL_TOKENS tokens, and each two blocks make a cell. Within a cell candidates share
    as many prefix tokens as both nodes ask for; they are verified on the whole sets.
    entries: rows of all lists.
    """
    lists = _lists(prefixes)
    mixed = lists.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.min(F.struct((F.col("n") - F.col("shared")).alias("own"), "n", "node"))["node"].alias("hub"),
    )
    members = stage(
        lists.join(mixed.where("lo < hi").select("token", "hub"), "token").select("hub", "node", "n").distinct(),
        "members", entries,
    )
    blocks = members.groupBy("hub").agg(F.ceil(F.sum("n") / CELL_TOKENS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = (
        members.select("hub", "node")
        .join(blocks, "hub")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    rows = cells.join(prefixes.drop("df"), "node").join(sets.select("node", "tokens"), "node")
    cell = ["hub", "i", "j"]

    def run(batches):
        key, held = None, []
        for b in batches:
            names = ("node", "n", "matches", "shared", "comp")
            keys = list(zip(*(b.column(c).to_pylist() for c in cell)))
            values = list(zip(*(b.column(c).to_pylist() for c in names)))
            prefix, tokens = b.column("prefix"), b.column("tokens")
            for i, now in enumerate(keys):
                if now != key and held:
                    yield from _cell_links(held, percent)
                    held = []
                key = now
                held.append((*values[i], prefix[i].values.to_numpy(), tokens[i].values.to_numpy()))
        if held:
            yield from _cell_links(held, percent)

    ordered = rows.repartition(*cell).sortWithinPartitions(*cell)
    return arrow_map(ordered, run, "a long, b long").distinct()


class _Postings:
    """Which of some sets hold a token."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner, self.size = tokens[order], owner[order], len(sets)

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set holds."""
        lo, hi = np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.owner[at], minlength=self.size)


def _cell_links(rows: list[tuple], percent: int):
    # A repeated document's node may be there twice.
    rows = list({r[0]: r for r in rows}.values())
    nodes, n, matches, shared, comp = (np.array([r[c] for r in rows], np.int64) for c in range(5))
    names, comp = np.unique(comp, return_inverse=True)
    if len(names) < 2:
        return
    # Only nodes outside the largest component start a comparison.
    largest = int(np.bincount(comp).argmax())
    prefixes = _Postings([r[5] for r in rows])
    whole = None
    out: dict[str, list] = {"a": [], "b": []}
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in np.flatnonzero(comp != largest).tolist():
        found = prefixes.overlaps(rows[i][5])
        fits = (n * 100 >= n[i] * percent) & (n[i] * 100 >= n * percent)
        fits &= np.minimum(shared, shared[i]) * (100 + percent) >= (n + n[i]) * percent
        near = np.flatnonzero(fits & (comp != comp[i]) & (found >= np.minimum(matches, matches[i])))
        if not len(near):
            continue
        if whole is None:
            whole = _Postings([r[6] for r in rows])
        both = whole.overlaps(rows[i][6])[near]
        for j in near[both * 100 >= (n[near] + n[i] - both) * percent].tolist():
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out["a"].append(min(nodes[i], nodes[j]))
                out["b"].append(max(nodes[i], nodes[j]))
    if out["a"]:
        yield out


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    similar = both * 100 >= (F.size("x") + F.size("y") - both) * percent
    return pairs.join(left, "a").join(right, "b").where(similar).select("a", "b").distinct()


def similar_groups(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    return _groups(docs, n, percent, id_col, text_col).drop("ref")


def _ref(name: Column, text: Column) -> Column:
    """What stands for the identifier of a row that has none: a hash of the text."""
    return F.when(name.isNull(), F.xxhash64(text))


def _groups(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per row of docs: doc_id, ref, n_shingles, component_id."""
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).withColumn("ref", _ref(F.col("doc_id"), F.col("text")))
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = stage(_first_step(texts, n, percent, buckets), "prefixes")
    rows = first.where("kind = 0").select("doc_id", "ref", "n", "node")
    classes = rows.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("ref").alias("ref"), F.max("n").alias("n")
    )

    least_n = F.ceil(F.col("n") * percent / 100)
    asked = F.greatest(F.lit(1), F.ceil(least_n / 10))
    short = classes.withColumn("short", F.col("node").bitwiseAND(F.lit(SHORT)))
    open_ = short.join(_shared_counts(first), "short").where(F.col("shared") >= asked)
    # Counts come by tasks, one for each prefix token at most.
    known = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked_rows = 3 * known[0] + known[1] * (110 - percent) // 100
    open_ = stage(open_.select("node", F.col("rep").alias("doc_id"), "ref"), "open", asked_rows)
    sets = stage(_whole_sets(texts, open_, n), "sets")
    nodes, tokens = sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    prefixes = stage(_prefixes(sets, percent, tokens), "adaptive", tokens)
    entries = prefixes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]

    links, labels = None, None
    for turn in range(CHAINS + 1):
        at = prefixes.withColumn("comp", F.col("node"))
        if labels is not None:
            at = prefixes.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
        if turn < CHAINS:
            pairs = stage(_chained(at, turn, percent), "pairs", entries)
            # By tokens: the sets that are read, and those of the pairs.
            compared = tokens + 2 * pairs.count() * tokens // max(1, nodes)
            found = stage(_verified(pairs, sets, percent), "found", compared)
        else:
            found = stage(_across(at, sets, percent, entries), "found")
        links = found if links is None else links.union(found)
        many = links.count()
        labels = stage(components(links, rows=many), "labels", 2 * many)

    linked = labels.join(classes, "node").select("node", "label", "rep")
    names = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = linked.join(names, "label").select("node", "component_id")
    named = classes.join(linked, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    # The empty sets have no node and are groups of their own.
    return rows.join(named, "node", "left").select(
        "doc_id", "ref", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _whole_sets(texts: DataFrame, open_: DataFrame, n: int) -> DataFrame:
    """(node, n, tokens) of the nodes left, made anew from the text of one of their documents.

    A node whose document's row is repeated is there as often; what follows takes that.
    Of a node without an identifier the text is found by its hash, and taken once.
    """
    named = texts.select("doc_id", "text").join(broadcast_if_small(open_.select("node", "doc_id")), "doc_id")
    wanted = named.select("text", "node")
    nameless = stage(open_.where("doc_id is null").select("node", "ref"), "nameless", open_.count())
    if not nameless.isEmpty():
        found = texts.where("doc_id is null").join(broadcast_if_small(nameless), "ref")
        wanted = wanted.union(found.select("text", "node").distinct())

    def run(batches):
        for b in batches:
            out = {"node": [], "n": [], "tokens": []}
            for text, node in zip(b.column("text"), b.column("node").to_pylist()):
                s = shingles(text.as_py(), n)
                # A repeated identifier may belong to another text.
                if _node(s) == node:
                    out["node"].append(node)
                    out["n"].append(len(s))
                    out["tokens"].append(s.view(np.int64))
            yield out

    return arrow_map(wanted, run, "node long, n long, tokens array<long>")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose identifier names their component, with the columns of docs.

    Rows that share an identifier stay or go together; rows without one go by their texts.
    """
    groups = _groups(docs, n, percent, id_col, text_col)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_kept"), F.col("ref").alias("_ref")).distinct()
    name = F.col(f"`{id_col}`").cast("long")
    ref = _ref(name, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return docs.join(kept, name.eqNullSafe(F.col("_kept")) & ref.eqNullSafe(F.col("_ref")), "left_semi")
