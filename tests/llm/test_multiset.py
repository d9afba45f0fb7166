"""The multiset hash against sums worked out paragraph by paragraph."""

import hashlib
import io
import re
from collections import Counter
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import multiset

PARTS = re.compile(multiset.PARAGRAPHS)


def lanes(parts):
    """(count of every bit, number of paragraphs), modulo 2**14."""
    total = np.zeros(256, np.int64)
    for p in parts:
        digest = np.frombuffer(hashlib.sha256(p.encode()).digest(), np.uint8).reshape(4, 8)[:, ::-1]
        total += np.unpackbits(digest.copy(), axis=1, bitorder="little").ravel()
    return total % 16384, len(parts) % 16384


def printed(parts):
    total, n = lanes(parts)
    longs = [total[64 * i + k : 64 * i + 64 : 16] for i in range(4) for k in range(16)]
    return "".join(f"{x:04X}" for four in longs for x in four[::-1].tolist()) + f"{n:016X}"


def likeness(a, b):
    if printed(a) == printed(b):
        return 1.0
    (x, n), (y, m) = lanes(a), lanes(b)
    x, y = ((2 * v - k + 8192) % 16384 - 8192 for v, k in ((x, n), (y, m)))
    whole = int(x @ x) + int(y @ y)
    return max(2 * int(x @ y), 0) / whole if whole else 0.0


def expected(rows):
    """doc_id, fingerprints and likenesses of rows whose identifiers differ."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = PARTS.findall(text), PARTS.findall(edited)
        out.append((i, edited, printed(own), printed(new), likeness(own, new), likeness(own, PARTS.findall(after))))
    return sorted(out, key=repr)


def compared(df):
    fields = ["doc_id", "edited", multiset.printed(F.col("fp")), multiset.printed(F.col("edited_fp")), "near_edited", "near_next"]
    return sorted((tuple(r) for r in multiset.compare_documents(df).select(*fields).collect()), key=repr)


def some_rows(n):
    rng = np.random.default_rng(2)
    pool = [f"Part {k} é{'x' * (k % 7)}{end}" for k in range(60) for end in (". ", "!\n", "\n", "?! ", "日")]
    ids = rng.permutation(4 * n)[:n] - n
    return [(int(i), "".join(rng.choice(pool, rng.integers(0, 25)))) for i in ids]


@pytest.mark.parametrize("size", [400, 1 << 30])
def test_against_sums_of_paragraphs(spark, monkeypatch, size):
    """In one block and in many: the next document may lie in another block."""
    monkeypatch.setattr(multiset, "BLOCK_BYTES", size)
    rows = some_rows(150) + [(None, "no identifier."), (-(1 << 62), ""), (1 << 62, None), (10**6, "a.b.c." * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert compared(df) == expected(rows)


def test_blocks(spark):
    keys = [f"{k:03d}" for k in range(0, 600, 2)]
    cuts = keys[::7]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = sorted((r.key, r.block, r.guest) for r in multiset._in_blocks(df, cuts).collect())
    want = [(k, n // 7, False) for n, k in enumerate(keys)] + [(c, (n - 1) % len(cuts), True) for n, c in enumerate(cuts)]
    assert got == sorted(want)


def test_paragraphs_go_in_and_out_in_any_order(spark):
    a, b = ["one.", "two\n", "one.", "three!"], ["four?", "two\n"]
    texts = {"a": "".join(a), "turned": "".join(reversed(a)), "b": "".join(b), "both": "".join([*b, *a]), "none": ""}
    df = spark.createDataFrame([tuple(texts.values())], list(texts))
    fp = df.select(*[multiset.fingerprint(F.col(c)).alias(c) for c in texts])
    show = lambda c: multiset.printed(c)
    got = fp.select(
        show(F.col("a")), show(F.col("turned")), show(multiset.insert(F.col("a"), F.col("b"))), show(F.col("both")),
        show(multiset.delete(F.col("both"), F.col("a"))), show(F.col("b")), show(multiset.delete(F.col("a"), F.col("a"))),
        show(F.col("none")), multiset.likeness(F.col("none"), F.col("none")), multiset.likeness(F.col("a"), F.col("none")),
        multiset.likeness(F.col("a"), F.col("turned")),
    ).first()
    assert got[0] == got[1] == printed(a) and got[2] == got[3] and got[4] == got[5] and got[6] == got[7]
    assert tuple(got[8:]) == (1.0, 0.0, 1.0)


def test_lanes_wrap_by_themselves(spark):
    """16,384 times the same paragraph is nothing; deleting from nothing borrows from no other lane."""
    df = spark.createDataFrame([("x.",)], "p string")
    fp = multiset.fingerprint(F.col("p"))
    none = multiset.fingerprint(F.lit(""))
    many = fp
    for _ in range(14):
        df = df.withColumn("fp", many)
        many = multiset.insert(F.col("fp"), F.col("fp"))
    less, back = multiset.delete(none, fp), multiset.insert(multiset.delete(none, fp), fp)
    got = df.select(*[multiset.printed(c) for c in (many, less, back)]).first()
    lane, _ = lanes(["x."])
    count = len(got[0]) - 16
    assert set(got[0][:count]) == {"0"} and set(got[2][:count]) == {"0"}
    assert Counter(got[1][i : i + 4] for i in range(0, count, 4)) == {"3FFF": lane.sum(), "0000": 256 - lane.sum()}


def test_likeness_follows_shared_paragraphs(spark):
    rows = [(i, "".join(f"{i} {k}. " for k in range(40))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in multiset.compare_documents(df).collect()]
    assert all(0.2 < r.near_edited < 0.75 for r in got) and all(r.near_next < 0.3 for r in got)


def test_odd_rows(spark, odd, none):
    got = multiset.compare_documents(odd)
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert sorted((tuple(r) for r in got.select("doc_id", "text").collect()), key=repr) == sorted(rows, key=repr)
    by_text = {r.text: r.fp for r in got.select("text", multiset.printed(F.col("fp")).alias("fp")).collect()}
    assert by_text == {t: printed(PARTS.findall(t)) for _, t in rows}
    assert multiset.compare_documents(none).collect() == []
    one = spark.createDataFrame([(1, "alone. here")], "doc_id long, text string")
    assert compared(one) == expected([(1, "alone. here")])
    # Equal identifiers follow each other; the second's next is the document after them.
    same = spark.createDataFrame([(2, "x.y."), (2, "x.y."), (1, "zz.zz.")], "doc_id long, text string")
    assert sorted(r.edited for r in multiset.compare_documents(same).collect()) == ["x.x.", "x.zz", "zz.x.y"]


def test_plan_is_built_in_functions_only(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        multiset.compare_documents(spark.createDataFrame(some_rows(20), "doc_id long, text string")).explain()
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
