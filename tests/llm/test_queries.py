"""The registered queries over the smallest driver tables, and the pipeline against brute force."""

import base64
import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare, sql_engine
from tests.llm.test_similar import grams

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return sql_engine(FOLDER)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def collected(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return [r.asDict() for r in df.collect()]


def library(name):
    t = Tokenizer.from_file(public.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(entry._text.ORACLES))
def test_against_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == []


def test_token_files(spark, docs):
    encode, at, want = library("word_bpe_49k.json"), 0, []
    for i, text in docs:
        ids = np.array([*encode(text), 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = collected(spark, "op2_repair_files")
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_merge_replay(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, text in docs:
        ids = own.encode_ordinary(text)
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    got = collected(spark, "op3_merge_replay")
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_pages(spark, con):
    got = collected(spark, "op4_tag_ratio")
    assert len(got) == con.execute("SELECT count(*) FROM pages").fetchone()[0]
    assert all(r["text"] and r["n_chars"] == len(r["text"]) for r in got)


def test_counts_and_scores_have_all_rows(spark, docs):
    for name in ("op5_trie_counts", "op9_positive_unlabelled"):
        assert sorted(r["doc_id"] for r in collected(spark, name)) == [i for i, _ in docs]


def test_search(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in collected(spark, "op6_multiprobe"):
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -2
        best = set(ids[np.lexsort((ids, -score))[:5]].tolist())
        found = sorted(got[int(ids[q])])
        assert [n for n, _ in found] == [1, 2, 3, 4, 5]
        hits += len(best & {v for _, v in found})
    assert hits >= 0.9 * 5 * len(got)


def test_shards(spark, docs):
    got = collected(spark, "op7_bounded_ring")
    want = [(i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert sorted(slots) == list(range(24)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def groups(texts):
    """doc_id → smallest doc_id of its component, by comparing all pairs."""
    sets = {i: grams(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and 100 * len(a & b) >= 80 * len(a | b):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in collected(spark, "op8_adaptive_prefixes")}
    assert got == groups(docs)


def check_packed(rows, texts, window=1024):
    encode, seats = library("byte_bpe_50k.json"), defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        seats[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {i for i, _ in texts}
    for i, text in texts:
        ids, at = np.array([*encode(text), 0], "<u4"), 0
        for start, n, crc, total in sorted(pieces[i]):
            assert (start, crc, total) == (at, zlib.crc32(ids[at : at + n].tobytes()), len(ids))
            at += n
        assert at == len(ids)
    padding = 0
    for parts in seats.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    assert padding <= window


def test_packing(spark, docs):
    check_packed(collected(spark, "op10_packing"), docs)


def test_pipeline(spark, docs):
    """Every stage by itself, on what the one before kept."""
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = frame.columns
    scores = {r["doc_id"]: r["predicted"] for r in collected(spark, "op9_positive_unlabelled")}
    texts = {i: t for i, t in docs if not scores[i]}
    last = {}
    for i, t in sorted(texts.items()):
        last[t.encode().lower()] = i
    texts = {i: texts[i] for i in last.values()}
    near = groups(sorted(texts.items()))
    texts = {i: t for i, t in texts.items() if near[i][1] == i}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == columns, name
    assert sorted(r.doc_id for r in frame.select("doc_id").collect()) == sorted(texts)
    check_packed([r.asDict() for r in corpus_pipeline.run(spark, FOLDER).collect()], sorted(texts.items()))
