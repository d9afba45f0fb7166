"""Encoders, token files, merge replay, counts and packing against the libraries themselves."""

import base64
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isobar.llm import merge_replay, packing, repair, token_counts, tokens

WORDS, BYTES = public.path("word_bpe_49k.json"), public.path("byte_bpe_50k.json")
RANKS = public.path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(alphabet=st.sampled_from("aBéß.,'’st  \n\t\r\x0b\x1c\x85\xa0 ́\0İ9٣日😀-"), max_size=40)


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_encoders_agree_with_the_library(text):
    for encoder, path in ((tokens.word_encoder(WORDS), WORDS), (tokens.byte_encoder(BYTES), BYTES)):
        assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == LIBRARY[path](text)


LIBRARY = {p: library(p) for p in (WORDS, BYTES)}


def test_special_strings_are_text():
    text = "a <|endoftext|> b<|endoftext|>"
    for encoder, path in ((tokens.word_encoder(WORDS), WORDS), (tokens.byte_encoder(BYTES), BYTES)):
        assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == LIBRARY[path](text)


WORD = st.text(alphabet=st.sampled_from("aBéßs9.,'’$#日…İ"), min_size=1, max_size=6)
EVEN = st.lists(WORD, min_size=1, max_size=8).flatmap(
    lambda words: st.lists(st.sampled_from(" \n"), min_size=len(words), max_size=len(words)).map(
        lambda gaps: "".join(g + w for g, w in zip(gaps, words))[1:]
    )
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | TEXT | EVEN, max_size=6), st.sampled_from([1, 30, 1 << 24]), st.sampled_from([1, 3, 1 << 19]))
def test_columns_agree_with_the_library(texts, size, gather):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tokens, "SLICE", size)
        m.setattr(tokens, "GATHER", gather)
        for encoder, path in ((tokens.word_encoder(WORDS), WORDS), (tokens.byte_encoder(BYTES), BYTES)):
            got = encoder.column(pa.array(texts, pa.string()))
            assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == [LIBRARY[path](t or "") for t in texts]


@pytest.mark.parametrize("path, chunks, lower", [(BYTES, tokens.byte_chunks, False), (WORDS, tokens.word_chunks, True)])
def test_a_column_asks_once_for_a_word(path, chunks, lower):
    encoder, asked = tokens.Encoder(path, chunks, lower), []
    for cache in (encoder.cache, encoder.spaced):
        cache.get = lambda words, get=cache.get: asked.extend(words) or get(words)
    encoder.column(pa.array(["one cat, one dog. A cat... a dog!"] * 500))
    assert len(asked) < 20


def test_a_column_asks_once_for_both_cases():
    encoder, asked = tokens.Encoder(WORDS, tokens.word_chunks, True), []
    encoder.cache.get = lambda words, get=encoder.cache.get: asked.extend(words) or get(words)
    # Behind another text of the buffer; the marks compose with a small letter, but with no capital.
    texts = pa.array(["before", "Cat CAT, cat. dOg\nDog!", "H\u0331 h\u0331 T\u0308, W\u030a I\u0307 \u0130", None])[1:]
    got = encoder.column(texts)
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == [LIBRARY[WORDS](t or "") for t in texts.to_pylist()]
    assert {w for w in asked if w.isascii() and w.isalpha()} == {"cat", "dog"}


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([5, 300, 4000]))
def test_pairs_that_share_a_slot(seed, letters):
    """Pairs are found whatever slots they have."""
    x = np.minimum(np.random.default_rng(seed).zipf(1.2, 4000), letters).astype("<u2")
    want = repair.compress(x)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(repair, "_slot", lambda codes: np.zeros(len(codes), np.uint32))
        got = repair.compress(x)
    assert all((a == b).all() for a, b in zip(got, want))


def test_operators_encode_by_columns(odd, monkeypatch):
    """Neither token files nor packing go through a text at a time."""
    for module, name in ((packing, "byte_encoder"), (repair, "word_encoder")):
        monkeypatch.setattr(module, name, lambda path, get=getattr(tokens, name): _Columns(get(path)))
    assert packing.encoded(odd, BYTES, 0, 1024).count() == odd.count()
    assert repair.read_documents(repair.write_shards(odd, WORDS, 2)).count() == odd.count()


class _Columns:
    def __init__(self, encoder):
        self.dtype, self.column = encoder.dtype, encoder.column


def test_cache_forgets():
    cache = tokens.WordCache(lambda words: [w.upper() for w in words], limit=4)
    for batch in (["a", "b", "a"], ["c", "d", "a"], ["e", "f"], ["a", "e"]):
        assert cache.get(batch) == [w.upper() for w in batch]
    assert len(cache.known) <= 6


def test_cache_keeps_what_is_asked_for():
    made = []
    cache = tokens.WordCache(lambda words: made.extend(words) or words, limit=8)
    for i in range(40):
        cache.get(["often", str(i)])
    assert made.count("often") == 1


def test_hashing_shingles_remembers_no_words():
    from isobar.llm import jaccard

    cache = tokens.WordCache(lambda words: words)
    cache.get(["a", "b"])
    assert len(jaccard.shingles("a b c d e f")) == 2
    assert not hasattr(jaccard, "_WORDS")
    tokens.WordCache.forget()
    assert not cache.known and not cache.older


def test_a_word_with_a_stop_is_encoded_once(monkeypatch):
    encoder, made = tokens.Encoder(BYTES, tokens.byte_chunks, False), []
    encode = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda word: made.append(word) or encode(word))
    for text in ("the zorbling came", "a zorbling, zorbling."):
        assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == LIBRARY[BYTES](text)
    assert made.count(" zorbling") == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(0, 299), st.integers(0, 300))
def test_grammar_round_trip(ids, start, length):
    x = np.array(ids, "<u2")
    alphabet, rules, sequence = repair.compress(x)
    grammar = repair.Grammar(alphabet, rules, repair.rule_lengths(len(alphabet), rules), sequence)
    assert grammar.read(0, len(x)).tolist() == ids
    length = max(0, min(length, len(ids) - start))
    assert grammar.read(start, length).tolist() == ids[start : start + length]


def test_grammar_shrinks_repeats():
    x = np.tile(np.arange(50), 200).astype("<u2")
    alphabet, rules, sequence = repair.compress(x)
    assert len(sequence) + 3 * len(rules) < len(x) / 10


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_token_files(odd, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    files = repair.write_shards(odd, WORDS, end_id=2)
    got = defaultdict(list)
    for r in repair.read_documents(files).collect():
        got[r.doc_id].append((r.n_tokens, r.ids_crc32, r.start))
    want, starts = defaultdict(list), set()
    for r in odd.collect():
        ids = np.array([*LIBRARY[WORDS](r.text or ""), 2], "<u4")
        want[r.doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
    assert {k: sorted(x[:2] for x in v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for key in sorted(got, key=lambda k: (k is not None, k or 0)):
        for n, _, start in sorted(got[key], key=lambda x: x[2]):
            assert start == at
            starts.add(start)
            at += n
    assert len(starts) == odd.count()


def test_token_files_of_nothing(none):
    assert repair.read_documents(repair.write_shards(none, WORDS, end_id=2)).count() == 0


def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_replay_agrees_with_the_library(texts):
    bpe = merge_replay.codec(RANKS, public.PATTERN)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == TIK.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


TIK = tik()


def test_lower_rank_made_by_a_merge_comes_first(tmp_path):
    # "bc" joins late, but then makes "abc" and "bcd", which rank before it.
    words = [bytes([b]) for b in range(256)] + [b"abc", b"xbc", b"bc", b"cb", b"bcbc"]
    path = tmp_path / "v"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % i for i, w in enumerate(words)))
    bpe = merge_replay.ByteBPE(str(path), public.PATTERN)
    ranks = {w: i for i, w in enumerate(words)}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["abcbc", "bcbcbc", "abcabcbc", "xbcbcabc", "cbcbcb", "bbbccc"]
    assert [x.tolist() for x in bpe.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_replay_of_rows(odd, none):
    rows = merge_replay.round_trip(odd, RANKS, public.PATTERN).collect()
    assert len(rows) == odd.count()
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(r.text or "")
    for r in rows:
        text = bytes(r.decoded).decode()
        assert text in texts[r.doc_id] and r.ids == TIK.encode_ordinary(text)
    assert merge_replay.round_trip(none, RANKS, public.PATTERN).count() == 0
    with pytest.raises(ValueError):
        merge_replay.codec(RANKS, public.PATTERN).decode(np.array([60_000]))


PIECES = public.path("piece_bpe_32k.model")


def best_split(word, pieces, unknown):
    """Highest score, then fewest tokens, over all segmentations."""
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        found = []
        for start in range(end):
            if word[start:end] in pieces:
                s, n = best[start]
                found.append((s + pieces[word[start:end]], n - 1))
        if word[end - 1] not in pieces:
            s, n = best[end - 1]
            found.append((s + unknown, n - len(word[end - 1].encode())))
        best[end] = max(found)
    return -best[-1][1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="theingao ▁\n😀é", max_size=25))
def test_counts_against_brute_force(text):
    shared = token_counts.trie(PIECES)
    want = sum(best_split(w, shared.pieces, shared.unknown) for w in token_counts.pre_tokens(text))
    assert shared.tokens_of(text)[0] == want


def test_words_are_counted_by_levels(monkeypatch):
    """No word of ordinary length is inserted by itself."""
    def refuse(self, word):
        raise AssertionError(word)

    monkeypatch.setattr(token_counts.ScoreTrie, "count", refuse)
    shared = token_counts.ScoreTrie(token_counts.read_pieces(PIECES))
    texts = [" ".join(f"th{a}ing{b}er" for b in range(40)) for a in range(40)]
    want = [sum(best_split(w, shared.pieces, shared.unknown) for w in token_counts.pre_tokens(t)) for t in texts[:3]]
    assert [shared.tokens_of(t)[0] for t in texts][:3] == want


COUNTED = st.lists(st.none() | st.text(alphabet="theing ▁\n😀é日", max_size=25), max_size=6)


@settings(max_examples=200, deadline=None)
@given(COUNTED, st.sampled_from([1, 20, 1 << 24]), st.sampled_from([0, 3, 64]), st.sampled_from([3, 400_000]))
def test_counts_of_columns(texts, size, depth, nodes):
    shared = token_counts.trie(PIECES)
    with pytest.MonkeyPatch.context() as m:
        for name, value in (("SLICE", size), ("DEPTH", depth), ("NODES", nodes)):
            m.setattr(token_counts, name, value)
        tokens, numbers = shared.column(pa.array(texts, pa.string()))
    words = [token_counts.pre_tokens(t or "") for t in texts]
    assert numbers.tolist() == [len(x) for x in words]
    assert tokens.tolist() == [sum(best_split(w, shared.pieces, shared.unknown) for w in x) for x in words]


def test_no_piece_crosses_pre_tokens():
    assert not [p for p in token_counts.read_pieces(PIECES) if "▁" in p.lstrip("▁")]


def test_counts_of_rows(odd, none, monkeypatch):
    monkeypatch.setattr(token_counts, "NODES", 3)
    rows = token_counts.count_tokens(odd, PIECES).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and by_id[3].n_tokens == by_id[4].n_tokens == 0
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert by_id[5].n_tokens == len(sp.encode("x"))
    assert token_counts.count_tokens(none, PIECES).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=30))
def test_plan_places_every_id_once(histogram):
    placed, sequences = packing.plan(histogram, 64)
    covered, seats = defaultdict(list), defaultdict(list)
    for source, first, end, skip, n, sequence, offset in placed:
        for k in range(first, end):
            covered[source, k].append((skip, n))
            seats[sequence + k - first].append((offset, n))
    assert set(covered) == {(v, k) for v, c in histogram.items() for k in range(c)}
    for (source, _), parts in covered.items():
        at = 0
        for skip, n in sorted(parts):
            assert skip == at
            at += n
        assert at == source
    assert sorted(seats) == list(range(sequences))
    for parts in seats.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or at & (at - 1) == 0


def test_least_squares_solves_a_known_mixture():
    lengths, counts = np.array([10, 22, 32, 54]), np.array([70.0, 30.0, 70.0, 40.0])
    uses = [(10, 54), (10, 22, 32), (32, 32)]
    x = packing.nnls(uses, lengths, counts, rounds=3000)
    assert np.allclose(x, [40, 30, 20], atol=0.01)


@pytest.mark.parametrize("window", [8, 1024])
def test_packing(odd, window):
    got = packing.pack(odd, BYTES, end_id=0, window=window).collect()
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(np.array([*LIBRARY[BYTES](r.text or ""), 0], "<u4").tobytes())
    pieces, seats = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        seats[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
    for key, want in texts.items():
        # Every id of a repeated document is there as often as the document.
        times = np.zeros(len(want[0]) // 4, int)
        for start, part, n in pieces[key]:
            assert n == len(times) and part == want[0][4 * start : 4 * start + len(part)]
            times[start : start + len(part) // 4] += 1
        assert (times == len(want)).all()
    assert sorted(seats) == list(range(len(seats)))
    for parts in seats.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window


def test_packing_of_nothing(none):
    assert packing.pack(none, BYTES).count() == 0


def test_blocks_of_the_replay(monkeypatch):
    """Words of a block are written by bucket and their ids found again by number."""
    import regex

    monkeypatch.setattr(merge_replay, "LIST_WORDS", 5)
    bpe = merge_replay.ByteBPE(RANKS, public.PATTERN)
    texts = ["the cat, the dog", "", "日本語 the\n\n cat's 12345", " ", "x" * 300]
    rows = [
        {k: v[0] for k, v in r.items()}
        for r in merge_replay._numbered(7, list(range(5)), texts, regex.compile(public.PATTERN).findall, 3)
    ]
    lists = [r for r in rows if r["kind"] == merge_replay.LISTS]
    assert len(lists) > 1 and sum((r["doc_ids"] for r in lists), []) == [0, 1, 2, 3, 4]
    words = sorted((r for r in rows if r["kind"] == merge_replay.WORDS), key=lambda r: r["place"])
    seen = [w for r in words for w in merge_replay._split(r["words"], r["n"])]
    assert len(seen) == len(set(seen))
    packed = [(r["block"], r["place"], r["n"], r["words"]) for r in words]
    back = [(r["words"][0], r["n"][0]) for r in merge_replay._replayed(bpe, packed)]
    (bucket_of,) = [merge_replay._unpacked(r["lists"]) for r in rows if r["kind"] == merge_replay.BUCKET_OF]
    block = merge_replay._Block(bucket_of, back, bpe.dtype)
    ids = [x for r in lists for x in block.ids(merge_replay._unpacked(r["lists"]), r["counts"])]
    assert [x.tolist() for x in ids] == [x.tolist() for x in bpe.encode(texts)]
    assert [bpe.decode(x).decode() for x in ids] == texts
