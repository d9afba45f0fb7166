"""The source divergence audit against term-by-term integer arithmetic."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from isobar.llm import divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LETTERS = str.maketrans("0123456789", "abcdefghij")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_terms(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    used, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        used[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: used[lang, s][t] for t in kept})

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        shares, q = {s: p(used[lang, s]) for s in sources}, p(whole)
        for s in sources:
            far = [(-sum((shares[s][t] - shares[o][t]) ** 2 // shares[o][t] for t in kept), o.encode()) for o in sources if o != s]
            near = [
                (-((shares[s][t] - q[t]) ** 2 // q[t]), t.encode())
                for t in kept
                if used[lang, s][t] > 0 and shares[s][t] > q[t]
            ]
            for part, items in (("pair", sorted(far)), ("term", sorted(near)[:top])):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(out)


def audited(df, **options):
    out = divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in out.collect())


def test_against_every_term(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("w", "É", "語", "Z") for b in ("", "a", "bc", "é", "ÿz", "q", "x")]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = []
    for _ in range(400):
        lang, source = rng.choice(["en", "de"]), f"s{int(rng.zipf(1.6)) % 7}"
        order = np.roll(words, int(source[1:]))
        rows.append((" 1_".join(rng.choice(order, rng.integers(0, 30), p=weight / weight.sum())), lang, source))
    rows += [("only twice", "fr", "a"), ("only twice", "fr", "b"), ("", "en", "wordless"), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert audited(df) == by_terms(rows)
    # Few ranks and many ties: the last value is cut in UTF-8 order.
    assert audited(df, min_docs=1, top=4) == by_terms(rows, 1, 4)


def test_odd_rows(spark, odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert audited(odd, min_docs=1) == by_terms(rows, 1)
    assert audited(odd) == by_terms(rows)
    assert audited(none) == []


def test_counts_do_not_overflow(spark):
    """Counts beyond 9 * 10**9, which times the scale pass 64 bits."""
    big = 40_000_000_000
    kept = [("en", "a", big + 5, [("s", big), ("t", 5)]), ("en", "b", 7, [("t", 7)])]
    kept = spark.createDataFrame(kept, "lang string, term string, lang_n long, held array<struct<source:string,n:long>>")
    groups = spark.createDataFrame(
        [("en", "s", big, 2, big + 12), ("en", "t", 12, 2, big + 12)],
        "lang string, source string, total long, v long, lang_total long",
    )
    cells = divergence.count_cells(kept)
    p = lambda n, total: 1 + 10**9 * (n + 1) // (total + 2)
    s, t = [p(big, big), p(0, big)], [p(5, 12), p(7, 12)]
    q = [p(big + 5, big + 12), p(7, big + 12)]
    far = lambda x, y: sum((a - b) ** 2 // b for a, b in zip(x, y))
    got = {(r.source, r["value"]) for r in divergence.source_pairs(kept, cells, groups).collect()}
    assert got == {("s", far(s, t)), ("t", far(t, s))}
    got = {(r.source, r["item"], r["value"]) for r in divergence.strongest_terms(kept, cells, groups, 5).collect()}
    want = {("t", "b", (t[1] - q[1]) ** 2 // q[1])}
    if s[0] > q[0]:
        want.add(("s", "a", (s[0] - q[0]) ** 2 // q[0]))
    assert got == want


def test_tables_of_a_task_are_bounded(monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 3)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 5)
    texts = ["one two three two", "", "ONE-éé one " * 9, "x" * 50]
    batch = pa.record_batch([pa.array(["en"] * 4), pa.array(["a", "a", "b", "b"]), pa.array(texts)], names=["lang", "source", "text"])
    seen, docs, parts = Counter(), Counter(), 0
    for out in divergence._count([batch]):
        parts += 1
        for s, t, n, d in zip(out["source"], out["term"].to_pylist(), out["n"], out["docs"]):
            seen[s, t] += n
            docs[s, t] += d
    assert parts > 2
    assert seen == {("a", "one"): 1, ("a", "two"): 2, ("a", "three"): 1, ("b", "one"): 18, ("b", "éé"): 9, ("b", "x" * 50): 1}
    assert docs == dict.fromkeys(seen, 1)


def test_counts_travel_in_blocks(spark):
    """A task hands on a row for a bucket of terms, not for every term of every source."""
    rows = [(" ".join(f"w{k:03}".translate(LETTERS) for k in range(i, i + 400)), "en", f"s{i % 5}") for i in range(20)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    blocks = divergence.term_counts(df).collect()
    assert len(blocks) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = [{c: np.frombuffer(b[c], "<u4") for c in ("n", "docs", "term")} for b in blocks]
    assert sum(int(x["n"].sum()) for x in numbers) == sum(int(x["docs"].sum()) for x in numbers) == 20 * 400
    assert sum(len(bytes(b.terms).split(b" ")) for b in blocks) == 419
    assert audited(df) == by_terms(rows)


def test_texts_longer_than_a_slice(monkeypatch):
    """Slices, long texts and the texts between them give what one table of all texts gives."""
    texts = ["a b", "long " * 9, "", "c a", None, "b " * 20 + "é", "a", "c"]
    rows = [(t, "en", f"s{i % 2}") for i, t in enumerate(texts)]
    batch = pa.record_batch(
        [pa.array(["en"] * len(rows)), pa.array([r[2] for r in rows]), pa.array([r[0] or "" for r in rows])],
        names=["lang", "source", "text"],
    )

    def entries():
        n, docs = Counter(), Counter()
        for out in divergence._count([batch]):
            for s, t, a, b in zip(out["source"], out["term"].to_pylist(), out["n"], out["docs"]):
                n[s, t] += int(a)
                docs[s, t] += int(b)
        return n, docs

    whole = entries()
    for size in (1, 4, 30):
        monkeypatch.setattr(divergence, "SLICE_BYTES", size)
        monkeypatch.setattr(divergence, "ENTRIES", 2)
        assert entries() == whole
    assert whole[0]["s1", "b"] == 20 and whole[1]["s1", "b"] == 1
