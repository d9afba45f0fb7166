"""Fill-in-the-middle against a version that splits and joins lists of units."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import example, given, settings
from hypothesis import strategies as st

from isobar.llm import fim

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_version(i, text, seed=1, rate=90, spm_rate=20):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    x, y = sorted(v % (len(units) + 1) for v in h[:2])
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= rate:
        return (i, len(units), "plain", None, None, text)
    a, b, c = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if h[3] % 100 < spm_rate:
        return (i, len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}")
    return (i, len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("azAZ@[`{ é日😀\n\0"), max_size=40), max_size=8))
@example(["", "", ""])
@example(["a", "", "b", "Zz" * 30])
def test_marks_find_every_unit(texts):
    raw = [t.encode() for t in texts]
    data = np.zeros((sum(map(len, raw)) + 15) // 8 * 8, np.uint8)
    data[: sum(map(len, raw))] = np.frombuffer(b"".join(raw), np.uint8)
    stops = np.cumsum([0, *map(len, raw)])
    ends, chars = fim.mark_units(data, stops[1:][stops[1:] > stops[:-1]])
    want, points, at = [], [], 0
    for t in texts:
        for unit in UNITS.findall(t):
            want.append(at + len(unit.encode()) - 1)
            points += [at + len(unit[:k].encode()) for k in range(len(unit))]
            at += len(unit.encode())
    assert ends.select(np.arange(1, len(want) + 1)).tolist() == want
    where = np.arange(at + 1)
    assert ends.rank(where).tolist() == [sum(w < p for w in want) for p in where]
    assert chars.rank(where).tolist() == [sum(w < p for w in points) for p in where]


def test_against_lists_of_units(spark):
    alphabet = ["word", "Ä", " ", "\n", "日本", "😀", "x1", "<", ">", "\x1c", "'"]
    rng = np.random.default_rng(5)
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(0, 60)))) for i in range(600)]
    rows += [(1000, "<P>"), (1001, "a<S>b"), (1002, "<M"), (1003, "no space " * 300_000), (1004, "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for options in ({}, {"seed": 7, "rate": 100, "spm_rate": 50}):
        out = fim.transform(df, **options)
        got = sorted(tuple(r) for r in out.collect())
        assert got == sorted(plain_version(*r, **options) for r in rows)
        back = out.select("doc_id", fim.restored(out.output, out.form).alias("text"))
        assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_marks_are_a_parameter(spark):
    df = spark.createDataFrame([(i, f"|P| a.b+c {i}") for i in range(40)], "doc_id long, text string")
    marks = ("|P", "(S)", "$")
    assert {r.form for r in fim.transform(df, marks=marks).collect()} == {"plain"}
    marks = ("(P)", "|S|", "$")
    out = fim.transform(df, rate=100, marks=marks)
    assert {r.form for r in out.collect()} == {"psm", "spm"}
    back = out.select(fim.restored(out.output, out.form, marks).alias("t"))
    assert sorted(r.t for r in back.collect()) == sorted(f"|P| a.b+c {i}" for i in range(40))


def test_odd_rows(spark, odd, none):
    want = sorted((plain_version(r.doc_id, r.text) for r in odd.collect()), key=repr)
    assert sorted((tuple(r) for r in fim.transform(odd).collect()), key=repr) == want
    assert fim.transform(none).collect() == []
    empty = spark.createDataFrame([(i, "") for i in range(9)], "doc_id long, text string").coalesce(1)
    assert {(r.n, r.form, r.output) for r in fim.transform(empty).collect()} == {(0, "plain", "")}


def test_blocks_hold_every_row(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK_BYTES", 50)
    texts = ["", "x" * 120, "ab", "", "é" * 20, "c" * 49, "d", ""]
    batch = pa.record_batch([pa.array(range(10)), pa.array(["skip", *texts, "skip"])], names=["doc_id", "text"])
    got = [
        (i, data[lo:hi].tobytes().decode())
        for ids, data, offsets in fim._blocks([batch.slice(1, 8)])
        for i, lo, hi in zip(ids, offsets[:-1], offsets[1:])
    ]
    assert got == list(enumerate(texts, 1))
