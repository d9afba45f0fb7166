"""Token counts under a unigram vocabulary, by dynamic programming on a shared trie.

A text is the vocabulary's word mark, then its characters with the mark for every
space. Pre-tokens are runs of marks with the characters up to the next one; no piece
crosses their edges, so the best segmentation of a text is that of its pre-tokens.
Distinct pre-tokens of some MB of texts go into a trie, in their order and level by level:
a level's nodes, one for each prefix of its length, are numbers in arrays. Long words are
inserted one by one. A node holds the best forward score of its
prefix, the largest sum of piece scores that ends there, and the number of tokens of
that segmentation; words with a common beginning share its nodes and scores. The count
of a word is that of its terminal node. Scores are the vocabulary file's own.

A character without a piece of its own costs as many tokens as it has bytes, at a
score below all others. Equal scores go to fewer tokens.

Defined results: a null or empty text has no tokens; repeated rows count alike; an
empty table gives an empty result. Columns besides the two named are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from isobar.llm.base import arrow_map, id_and_text

#: Fixed value: stands for a space in the vocabulary.
MARK = "▁"
NODES = 400_000
# Bytes of text whose words are told apart at once, and the characters of a word that is inserted by levels.
SLICE, DEPTH = 1 << 24, 64

_PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*")


def pre_tokens(text: str) -> list[str]:
    return _PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def read_pieces(path: str) -> dict[str, float]:
    """Piece → score, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        sp.id_to_piece(i): sp.get_score(i)
        for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    }


class Endings:
    """Pieces that end with a character: a trie of the pieces read backwards, its edges sorted."""

    def __init__(self, pieces: dict[str, float]):
        letters = sorted({c for p in pieces for c in p})
        number = {c: i for i, c in enumerate(letters, 1)}
        # Number of every code point; 0 is one that no piece has.
        self.number = np.zeros(0x110000, np.int64)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        self.single = np.zeros(self.letters, bool)
        self.single[[number[p] for p in pieces if len(p) == 1]] = True
        self.longest = max(map(len, pieces), default=0)
        nodes = {"": 0}
        for piece in pieces:
            for at in range(len(piece) - 1, -1, -1):
                nodes.setdefault(piece[at:], len(nodes))
        # A node that is no piece, only the end of one, scores too little to be chosen.
        self.scores = np.array([pieces.get(end, -np.inf) for end in nodes])
        edges = sorted((nodes[end[1:]] * self.letters + number[end[0]], node) for end, node in nodes.items() if end)
        # The last edge is none.
        edges.append((np.iinfo(np.int64).max, 0))
        self.edges, self.nodes = (np.array(x, np.int64) for x in zip(*edges))

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child by the letter, and those children."""
        edges = nodes * self.letters + letters
        at = np.searchsorted(self.edges, edges)
        on = np.flatnonzero(self.edges[at] == edges)
        return on, self.nodes[at[on]]


class ScoreTrie:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        # Piece lengths by last character: what can end at a node.
        self.lengths: dict[str, list[int]] = {}
        for p in sorted(pieces, key=lambda p: (len(p), p)):
            known = self.lengths.setdefault(p[-1], [])
            if len(p) not in known:
                known.append(len(p))
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.endings = Endings(pieces)
        self._clear()

    def _clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.score, self.tokens = [0.0], [0]

    def count(self, word: str) -> int:
        """Insert a word; tokens of its terminal node."""
        if len(self.children) > NODES:
            self._clear()
        node, path = 0, [0]
        for at, char in enumerate(word, 1):
            child = self.children[node].get(char)
            if child is None:
                child = self._grow(node, char, word, at, path)
            node = child
            path.append(node)
        return self.tokens[node]

    def _grow(self, node: int, char: str, word: str, at: int, path: list[int]) -> int:
        best, fewest = None, 0
        for n in self.lengths.get(char, ()):
            if n > at:
                break
            piece = self.pieces.get(word[at - n : at])
            if piece is not None:
                start = path[at - n]
                total, tokens = self.score[start] + piece, self.tokens[start] + 1
                if best is None or total > best or total == best and tokens < fewest:
                    best, fewest = total, tokens
        if char not in self.pieces:
            total, tokens = self.score[node] + self.unknown, self.tokens[node] + len(char.encode())
            if best is None or total > best:
                best, fewest = total, tokens
        child = self.children[node][char] = len(self.children)
        self.children.append({})
        self.score.append(best)
        self.tokens.append(fewest)
        return child

    def counts(self, words: pa.Array) -> np.ndarray:
        """Tokens of each of some distinct words."""
        out = np.zeros(len(words), np.int64)
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        order = pc.sort_indices(words).to_numpy().astype(np.int64)
        deep = lengths[order] > DEPTH
        for i in order[deep].tolist():
            out[i] = self.count(words[i].as_py())
        order = order[~deep]
        ends = np.cumsum(lengths[order])
        at = 0
        while at < len(order):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + NODES, "right")))
            some = order[at:to]
            out[some] = self._level_counts(words.take(pa.array(some)), lengths[some])
            at = to
        return out

    def _level_counts(self, words: pa.Array, lengths: np.ndarray) -> np.ndarray:
        """Tokens of words in ascending order, by a trie of their own."""
        endings = self.endings
        text = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
        begins = np.cumsum(lengths) - lengths
        # By depth: the node of each word's prefix; the scores and tokens of nodes; each word's last letter.
        places, scores, tokens, letters = [np.zeros(len(words), np.int64)], [np.zeros(1)], [np.zeros(1, np.int64)], [None]
        out = np.zeros(len(words), np.int64)
        rows = np.flatnonzero(lengths)
        while len(rows):
            depth = len(places)
            char, parent = text[begins[rows] + depth - 1], places[-1][rows]
            new = np.ones(len(rows), bool)
            new[1:] = (char[1:] != char[:-1]) | (parent[1:] != parent[:-1])
            place, letter = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            place[rows] = np.cumsum(new) - 1
            letter[rows] = endings.number[char]
            places.append(place)
            letters.append(letter)
            # A node is grown from the first word that has it.
            word, char, parent = rows[new], char[new], parent[new]
            best, fewest = np.full(len(word), -np.inf), np.zeros(len(word), np.int64)
            open_, ending = np.arange(len(word)), np.zeros(len(word), np.int64)
            for n in range(1, min(depth, endings.longest) + 1):
                on, ending = endings.step(ending, letters[depth - n + 1][word[open_]])
                open_ = open_[on]
                start = places[depth - n][word[open_]]
                total, count = scores[depth - n][start] + endings.scores[ending], tokens[depth - n][start] + 1
                better = (total > best[open_]) | (total == best[open_]) & (total > -np.inf) & (count < fewest[open_])
                best[open_[better]], fewest[open_[better]] = total[better], count[better]
            total = scores[-1][parent] + self.unknown
            alone = ~endings.single[letter[word]] & (total > best)
            # As many tokens as the character has bytes.
            size = 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
            scores.append(np.where(alone, total, best))
            tokens.append(np.where(alone, tokens[-1][parent] + size, fewest))
            ended = lengths[rows] == depth
            out[rows[ended]] = tokens[-1][place[rows[ended]]]
            rows = rows[~ended]
        return out

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, pre-tokens) of each text (null: empty), worked out for some MB of them at once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        found, at = [(np.zeros(0, np.int64),) * 2], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
            found.append(self._slice(texts[at:to]))
            at = to
        return tuple(np.concatenate(x) for x in zip(*found))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
        numbers = np.diff(cut.offsets.to_numpy())
        begins = np.cumsum(numbers) - numbers
        words = cut.flatten().dictionary_encode()
        index, words = words.indices.to_numpy(), words.dictionary
        # An empty word stands for marks in a row or at an end.
        odd = pc.equal(words, "").to_numpy(zero_copy_only=False)
        uneven = np.logical_or.reduceat(odd[index], begins)
        counts = self.counts(pc.binary_join_element_wise(pa.scalar(MARK, words.type), words, pa.scalar("", words.type)))
        tokens = np.add.reduceat(counts[index], begins)
        rest = np.flatnonzero(uneven)
        if len(rest):
            lists = [pre_tokens(t) for t in texts.take(pa.array(rest)).to_pylist()]
            seen = {w: i for i, w in enumerate(dict.fromkeys(w for words in lists for w in words))}
            counts = self.counts(pa.array(seen, pa.large_string())).tolist()
            numbers[rest] = [len(words) for words in lists]
            tokens[rest] = [sum(counts[seen[w]] for w in words) for words in lists]
        return tokens, numbers

    def tokens_of(self, text: str) -> tuple[int, int]:
        """(tokens, pre-tokens) of a text."""
        tokens, numbers = self.column(pa.array([text]))
        return int(tokens[0]), int(numbers[0])


_TRIES: dict[str, ScoreTrie] = {}


def trie(path: str) -> ScoreTrie:
    """One trie per worker process and vocabulary."""
    if path not in _TRIES:
        _TRIES[path] = ScoreTrie(read_pieces(path))
    return _TRIES[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_pretokens, n_chars of every row of docs."""

    def run(batches):
        shared = trie(path)
        for b in batches:
            tokens, numbers = shared.column(b.column(1))
            yield {
                "doc_id": b.column(0), "n_tokens": tokens, "n_pretokens": numbers,
                "n_chars": pc.utf8_length(b.column(1)).to_numpy(zero_copy_only=False),
            }

    return arrow_map(
        id_and_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, n_pretokens long, n_chars long"
    )
