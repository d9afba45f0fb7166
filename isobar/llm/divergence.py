"""How far the sources of a language diverge in their words, by ranking count cells.

Terms are runs of ASCII letters and of code points from U+0080, only A to Z lower-cased.
A language keeps the V terms that lie in at least `min_docs` of its documents. Every
(lang, source) group that occurs, and every language as a whole, gives each kept term
``p = 1 + floor(SCALE * (count + 1) / (N + V))``, where N sums the group's counts. How much
p differs from q is ``f = floor((p - q)**2 / q)``.

Many terms share their counts, so f is never worked out term by term. Terms of a group
are grouped by (count in the group, count in the language): a cell with as many terms as
fall in it. For the strongest terms, cells are evaluated, those of equal value merged, and
values ranked by the number of terms above them; only cells that reach into the first
`top` ranks are expanded into terms, in UTF-8 order. For two sources the cells are (count
here, count there): those with a count of 0 follow from the cells of each source alone,
so only terms that both have are ever met together.

Occurrences are counted over some MB of texts at once, shuffled in blocks by the bucket of
their term's hash, and summed up bucket by bucket: a row then holds the sources of one
term of a language. All arithmetic is on longs and 38-digit decimals.

Defined results: null texts, langs and sources count as ''; a group without terms takes
part with counts of 0; a language without kept terms has pairs of value 0 and no terms;
equal values rank by the UTF-8 order of their item; repeated rows count as documents of
their own; a very long text is counted slice by slice; an empty table gives an empty
result. Columns besides the three named are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.base import arrow_map, stage

SCALE = 1_000_000_000
#: Terms that a task counts before it hands them on: as many as lie in twice as many bytes, since every
#: term has a separator behind it. Texts longer than a slice are counted alone.
ENTRIES = 1 << 23
SLICE_BYTES = 1 << 20
BLOCKS = (
    "bucket int, langs array<string>, sources array<string>, terms binary, "
    "term binary, source binary, n binary, docs binary"
)
KEPT = "lang string, term string, lang_n long, held array<struct<source:string,n:long>>"

# A-Z become a-z, other bytes of terms stay, all else separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, by slices that end between terms."""
    at, size = 0, len(text)
    while at < size:
        to = text.find(b" ", at + SLICE_BYTES)
        to = size if to < 0 else to
        yield text[at:to].split(b" ")
        at = to


def _folded(texts: pa.Array) -> pa.Array:
    """The texts with terms lower-cased and spaces for all else; every byte keeps its place."""
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data[offsets[0] : offsets[-1]].to_pybytes().translate(_FOLD) if data else b""
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def _entries(groups: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(group, term, n, docs) of folded texts, where groups[i] is the group of text i; a row for each group of a term."""
    # Documents are numbered by group, so that those of a group stand together under each term.
    by_group = np.argsort(groups, kind="stable")
    number = np.empty(len(groups), np.int64)
    number[by_group] = np.arange(len(groups))
    cut = pc.split_pattern(texts, " ")
    words = cut.flatten().dictionary_encode()
    index, terms = words.indices.to_numpy().astype(np.int64), words.dictionary
    key = index * len(groups) + np.repeat(number, np.diff(cut.offsets.to_numpy()))
    nothing = pc.index(terms, pa.scalar("", terms.type)).as_py()
    if nothing >= 0:
        key = key[index != nothing]
    key.sort()
    met = np.flatnonzero(np.diff(key, prepend=-1))  # a document and a term
    term, doc = np.divmod(key[met], len(groups))
    group = groups[by_group][doc]
    first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
    n = np.diff(np.append(met[first], len(key)))
    docs = np.diff(np.append(first, len(met)))
    return group[first], pa.DictionaryArray.from_arrays(pa.array(term[first].astype(np.int32)), terms), n, docs


def _long(group: int, text: bytes) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]:
    """What `_entries` gives for one folded text, slice by slice."""
    counts = Counter()
    for terms in _slices(text):
        counts.update(terms)
    counts.pop(b"", None)
    terms = pa.array(list(counts), pa.binary()).cast(pa.large_string())
    ones = np.ones(len(terms), np.int64)
    codes = pa.array(np.arange(len(terms), dtype=np.int32))
    return group * ones, pa.DictionaryArray.from_arrays(codes, terms), np.fromiter(counts.values(), np.int64), ones


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Occurrences and documents of every term in a group, summed up over some MB of texts."""
    for b in batches:
        names: dict[tuple[str, str], int] = {}
        pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        groups = np.fromiter((names.setdefault(p, len(names)) for p in pairs), np.int64, len(b))
        langs, sources = (np.array([p[i] for p in names], object) for i in (0, 1))
        texts = b.column(2).cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(b):
            if sizes[at] > SLICE_BYTES:
                to = at + 1
                found = _long(int(groups[at]), texts[at].as_py().encode().translate(_FOLD))
            else:
                to = int(np.searchsorted(ends, ends[at] - sizes[at] + 2 * ENTRIES, "right"))
                long = np.flatnonzero(sizes[at:to] > SLICE_BYTES)
                to = max(at + 1, at + int(long[0]) if len(long) else to)
                found = _entries(groups[at:to], _folded(texts[at:to]))
            at = to
            group, term, n, docs = found
            if len(n):
                yield {"lang": langs[group], "source": sources[group], "group": group, "term": term, "n": n, "docs": docs}


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[dict]:
    """The counts of `_count`, a row for each bucket of terms."""
    for out in _count(batches):
        terms, code = out["term"].dictionary, out["term"].indices.to_numpy()
        raw = terms.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        bucket = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % buckets
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        raw = raw[order]
        place = place[code]
        entries = np.argsort(place, kind="stable")
        place = place[entries]
        group, n, docs = (out[k][entries] for k in ("group", "n", "docs"))
        lang, source = out["lang"][entries], out["source"][entries]
        cuts = np.searchsorted(place, edges).tolist()
        rows = {c: [] for c in ("bucket", "langs", "sources", "terms", "term", "source", "n", "docs")}
        for i in range(buckets):
            lo, hi = cuts[i], cuts[i + 1]
            if lo == hi:
                continue
            _, first, number = np.unique(group[lo:hi], return_index=True, return_inverse=True)
            rows["bucket"].append(i)
            rows["langs"].append(lang[lo:hi][first].tolist())
            rows["sources"].append(source[lo:hi][first].tolist())
            rows["terms"].append(b" ".join(raw[edges[i] : edges[i + 1]].tolist()))
            for c, v in (("term", place[lo:hi] - edges[i]), ("source", number), ("n", n[lo:hi]), ("docs", docs[lo:hi])):
                rows[c].append(v.astype("<u4").tobytes())
        yield rows


def term_counts(docs: DataFrame, text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """Blocks of (lang, source, term, n, docs): occurrences of every term and documents that hold it.

    A row has entries of one bucket of terms: `terms` are its distinct terms with spaces between; in the
    others, numbers of 32 bits, entry k is about term[k] of these, in langs[source[k]] and sources[source[k]].
    """
    named = docs.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(named, lambda batches: _blocks(batches, buckets), BLOCKS)


def _merged(blocks: pa.Table, min_docs: int, schema: pa.Schema) -> pa.Table:
    """Terms of one bucket as rows of `kept_terms`."""
    langs: dict[str, int] = {}
    groups: dict[tuple[str, str], int] = {}
    lang_of, group_of, terms, counts, before = [], [], [], [], 0
    for row in blocks.to_batches():
        names = [list(zip(a, b)) for a, b in zip(row["langs"].to_pylist(), row["sources"].to_pylist())]
        for pairs, *numbers in zip(names, *(row[c].to_pylist() for c in ("terms", "term", "source", "n", "docs"))):
            there = numbers[0].split(b" ")
            term, source, n, docs = (np.frombuffer(x, "<u4").astype(np.int64) for x in numbers[1:])
            group_of.append(np.array([groups.setdefault(p, len(groups)) for p in pairs], np.int64)[source])
            lang_of.append(np.array([langs.setdefault(p[0], len(langs)) for p in pairs], np.int64)[source])
            terms += there
            counts.append((term + before, n, docs))
            before += len(there)
    words = pa.array(terms, pa.binary()).dictionary_encode()
    term, n, docs = (np.concatenate(x) for x in zip(*counts))
    key = words.indices.to_numpy().astype(np.int64)[term] * len(langs) + np.concatenate(lang_of)
    key = key * len(groups) + np.concatenate(group_of)
    order = np.argsort(key)
    key = key[order]
    # Entries of a source, then those of a language.
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n, docs = (np.add.reduceat(x[order], first) for x in (n, docs))
    whole, group = np.divmod(key[first], len(groups))
    start = np.flatnonzero(np.diff(whole, prepend=-1))
    keep = np.add.reduceat(docs, start) >= min_docs
    sources = np.diff(np.append(start, len(whole)))
    term, lang = np.divmod(whole[start][keep], len(langs))
    inside = np.repeat(keep, sources)
    names = pa.array([source for _, source in groups], pa.string()).take(pa.array(group[inside]))
    held_type = schema.field("held").type
    held = pa.StructArray.from_arrays([names, pa.array(n[inside])], fields=list(held_type.value_type))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sources[keep])]).astype(np.int32))
    columns = [
        pa.array(list(langs), pa.string()).take(pa.array(lang)),
        words.dictionary.take(pa.array(term)).cast(pa.string()),
        pa.array(np.add.reduceat(n, start)[keep]),
        pa.ListArray.from_arrays(offsets, held, type=held_type),
    ]
    return pa.Table.from_arrays(columns, schema=schema)


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, lang_n, held): terms of enough documents; `held` lists (source, n), one entry a source."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(KEPT))
    return counts.groupBy("bucket").applyInArrow(lambda blocks: _merged(blocks, min_docs, target), KEPT)


def _share(count: str | Column, total: str, terms: str) -> Column:
    """p of a count, exactly; counts whose scaled form needs more than 64 bits take decimals."""
    count = F.col(count) if isinstance(count, str) else count
    whole = F.col(total) + F.col(terms)
    narrow = F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), whole)
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    wide = F.call_function("div", scaled, whole.cast("decimal(20,0)"))
    return F.when(count < 1 << 33, narrow).otherwise(wide) + 1


def _differ(p: str | Column, q: str | Column) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if top is None else out.where(F.col("rank") <= top)


def count_cells(kept: DataFrame) -> DataFrame:
    """(lang, source, n, lang_n, terms): how many terms of a group share both counts."""
    held = kept.select("lang", "lang_n", F.explode("held").alias("h"))
    return held.groupBy("lang", F.col("h.source").alias("source"), F.col("h.n").alias("n"), "lang_n").agg(
        F.count("*").alias("terms")
    )


def strongest_terms(kept: DataFrame, cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): terms more frequent in a group than in its language."""
    cell = ["lang", "source", "n", "lang_n"]
    cells = cells.join(groups, ["lang", "source"])
    cells = cells.withColumns({"p": _share("n", "total", "v"), "q": _share("lang_n", "lang_total", "v")})
    cells = cells.where("p > q").select(*cell, "terms", _differ("p", "q").alias("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    # Every value has a term at least: no more than `top` values matter.
    falling = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    values = values.withColumn("_k", F.row_number().over(falling)).where(F.col("_k") <= top)
    above = F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    reach = values.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top)
    least = reach.groupBy("lang", "source").agg(F.min("value").alias("least"))
    cells = cells.join(least, ["lang", "source"]).where("value >= least").select(*cell, "value")
    held = kept.select("lang", "term", "lang_n", F.explode("held").alias("h"))
    held = held.select("lang", "term", "lang_n", "h.source", "h.n")
    rows = held.join(cells, cell).select("lang", "source", F.col("term").alias("item"), "value")
    return _ranked(rows, top)


def source_pairs(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): divergence of every source from every other of its language.

    The sum over all V terms is V * f(0, 0), plus what each source's own terms change in
    it, plus what the terms of both change once more.
    """
    zero = F.lit(0).cast("long")
    size = groups.select("lang", "source", "total", "v", _share(zero, "total", "v").alias("p0")).where("v > 0")
    other = size.select("lang", *[F.col(c).alias(f"{c}_") for c in ("source", "total", "p0")])
    pairs = size.join(other, "lang").where("source <> source_")
    alone = cells.groupBy("lang", "source", "n").agg(F.sum("terms").alias("m"))
    alone = alone.join(size.select("lang", "source", "total", "v"), ["lang", "source"])
    alone = alone.select("lang", "source", "m", _share("n", "total", "v").alias("p"))
    sides = kept.select("lang", F.explode("held").alias("x"), "held")
    both = sides.select("lang", "x", F.explode("held").alias("y")).where("x.source < y.source")
    both = both.groupBy(
        "lang", F.col("x.source").alias("source"), F.col("y.source").alias("source_"), F.col("x.n").alias("a"), F.col("y.n").alias("b")
    ).agg(F.count("*").alias("m"))
    both = both.join(pairs, ["lang", "source", "source_"])
    both = both.withColumns({"p": _share("a", "total", "v"), "p_": _share("b", "total_", "v")})

    def times(m, *signed):
        """m * (f - f ...) in 38 digits."""
        return sum((f.cast("decimal(19,0)") * s for f, s in signed), F.lit(0).cast("decimal(19,0)")).cast("decimal(22,0)") * F.col(m).cast("decimal(16,0)")

    def change(p, p0, q, q0):
        return times("m", (_differ(p, q), 1), (_differ(p, q0), -1), (_differ(p0, q), -1), (_differ(p0, q0), 1))

    def part(source, item, value):
        return F.struct(F.col(source).alias("source"), F.col(item).alias("item"), value.alias("value"))

    met = F.array(
        part("source", "source_", change("p", "p0", "p_", "p0_")), part("source_", "source", change("p_", "p0_", "p", "p0"))
    )
    own = alone.join(pairs.select("lang", "source", "source_", "p0", "p0_"), ["lang", "source"])
    own = own.select("lang", F.inline(F.array(
        part("source", "source_", times("m", (_differ("p", "p0_"), 1), (_differ("p0", "p0_"), -1))),
        part("source_", "source", times("m", (_differ("p0_", "p"), 1), (_differ("p0_", "p0"), -1))),
    )))
    base = pairs.select("lang", "source", F.col("source_").alias("item"), times("v", (_differ("p0", "p0_"), 1)).alias("value"))
    parts = both.select("lang", F.inline(met)).union(own).union(base)
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    # Languages without kept terms have nothing to sum.
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang")
    rows = every.where("source <> item").join(sums, ["lang", "source", "item"], "left")
    return _ranked(rows.withColumn("value", F.coalesce("value", zero)))


def audit(
    docs: DataFrame,
    min_docs: int = 3,
    top: int = 200,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank), `part` being ``pair`` or ``term``."""
    kept = stage(kept_terms(term_counts(docs, text_col, lang_col, source_col), min_docs), "kept-terms")
    named = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"))
    ]
    occurring = docs.select(*named).distinct()
    cells = stage(count_cells(kept), "count-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("terms")).alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    groups = stage(
        occurring.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")]),
        "groups",
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(kept, cells, groups).withColumn("part", F.lit("pair")).select(*columns)
    terms = strongest_terms(kept, cells, groups, top).withColumn("part", F.lit("term")).select(*columns)
    return pairs.unionByName(terms)
