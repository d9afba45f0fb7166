"""Encoding whole texts by the public vocabularies, one lookup per word.

A word is encoded once per Python worker and then looked up, once for all texts of a
slice of a column. That is exact where a text is cut at a place no pre-token crosses:

* ``byte_chunks`` cuts before a run of white space. A pre-token of the byte-level
  pattern that holds a character other than white space holds none after it, and
  what follows is matched from there on without looking back.
* ``word_chunks`` cuts at spaces and line ends, which the lower-casing vocabulary
  drops; no character composes with them.
* ASCII signs at the end of a word are cut off behind a letter or a digit; a pre-token
  that holds one of those and a sign is a contraction, which does not end in a sign.
"""

from __future__ import annotations

import codecs
import re
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from isobar.llm.base import spans

#: The characters with Unicode's White_Space property.
WHITE_SPACE = "".join(
    map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)

_RARE = re.compile(f"[{WHITE_SPACE.replace(' ', '').replace(chr(10), '')}\0]")
# Bytes of text whose words are told apart at once, and words whose ids are gathered at once.
SLICE, GATHER = 1 << 24, 1 << 19
_RUNS = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


def even(text: str) -> bool:
    """Whether all white space is single spaces and line ends within the text; a zero byte is uneven too."""
    if text[:1] in " \n" or text[-1:] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    return _RARE.search(text) is None


def byte_chunks(text: str) -> list[str]:
    """Pieces that the byte-level pattern splits independently; joined they are the text."""
    if not even(text):
        return _RUNS.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def word_chunks(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


class WordCache:
    """chunk → value, filled in batches, of bounded size.

    Values lie in two halves. When the newer one is full it becomes the older one, whose
    values move back as they are asked for; those that were not are forgotten.
    """

    _all: weakref.WeakSet[WordCache] = weakref.WeakSet()

    def __init__(self, make, limit: int = 700_000):
        self.make, self.limit, self.known, self.older = make, limit, {}, {}
        WordCache._all.add(self)

    @classmethod
    def forget(cls) -> None:
        """Empty all caches of this process: a worker keeps them when it goes on to another operator."""
        for cache in cls._all:
            cache.known, cache.older = {}, {}

    def get(self, chunks: list[str]) -> list:
        found = list(map(self.known.get, chunks))
        if None in found:
            places = [i for i, v in enumerate(found) if v is None]
            asked = [chunks[i] for i in places]
            fresh = dict.fromkeys(asked)
            if self.older:
                fresh = dict(zip(fresh, map(self.older.get, fresh)))
                missing = [c for c, v in fresh.items() if v is None]
            else:
                missing = list(fresh)
            fresh.update(zip(missing, self.make(missing)))
            if len(self.known) + len(fresh) > self.limit // 2:
                self.known, self.older = {}, self.known
            self.known.update(fresh)
            for i, v in zip(places, map(fresh.__getitem__, asked)):
                found[i] = v
        return found


class Encoder:
    """Whole texts to ids, as little-endian unsigned integers of `dtype`.

    A column of texts is cut by Arrow, which also tells its distinct words apart; only
    those are looked up, without the signs at their end, and the ids of all words are
    gathered by their numbers.

    A chunk of Latin letters, digits and ASCII signs but the apostrophe is cut into
    pre-tokens here, which go to the tokenizer's model directly. All other chunks
    take the tokenizer's whole way.
    """

    def __init__(self, path: str, chunks, lower: bool):
        self.chunks, self.lower = chunks, lower
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.pieces = [np.array([i], self.dtype).tobytes() for i in range(self.tokenizer.get_vocab_size())]
        self.tokenize = self.tokenizer.model.tokenize
        self.line_end = b"" if lower else self._whole("\n")
        self.cache = WordCache(self._encode, 700_000 if lower else 100_000)
        # Words of even texts, each with the space before it left out or with the line end before it.
        self.spaced = WordCache(self._encode_spaced)

    def _whole(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word that is one pre-token."""
        # ASCII letters, digits and signs stand for themselves; only a space comes before them.
        chars = word
        if not word.isascii() or word[0] == " ":
            chars, _ = codecs.charmap_decode(word.encode(), "strict", _BYTE_CHARS)
        pieces = self.pieces
        return b"".join([pieces[t.id] for t in self.tokenize(chars)])

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return self._made(chunks, "", self.cache)

    def _encode_spaced(self, words: list[str]) -> list[bytes]:
        first = iter(self._encode([w[1:] for w in words if w[:1] == "\n"]))
        rest = iter(self._made([w for w in words if w[:1] != "\n"], " ", self.spaced))
        return [self.line_end + next(first) if w[:1] == "\n" else next(rest) for w in words]

    def _made(self, chunks: list[str], space: str, cache: WordCache) -> list[bytes]:
        """Ids of chunks, each with the space before it; the cache has them under the chunk alone."""
        out, latin, plain, made = [], _LATIN_WORD.match, _PLAIN.match, {}
        known, older, skip, word = cache.known.get, cache.older.get, len(space), self._word
        parts = (_LOWER_PARTS if self.lower else _PARTS).findall
        for chunk in chunks:
            text = space + (chunk.lower() if self.lower else chunk)
            if chunk.isascii() and chunk.isalpha() or latin(text):
                ids = made.get(text)
                if ids is None:
                    ids = made[text] = word(text)
            elif plain(text):
                # A word is often there already without what follows it.
                first, *others = parts(text)
                bare = first[skip:]
                ids = known(bare) or older(bare) or made.get(first)
                if ids is None:
                    ids = made[first] = word(first)
                for part in others:
                    if part not in made:
                        made[part] = word(part)
                    ids += made[part]
            else:
                ids = self._whole(space + chunk) if chunk else b""
            out.append(ids)
        return out

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.lower or not even(text):
            return b"".join(self.cache.get(self.chunks(text)))
        # The first word is taken as the first of a line, whose end is dropped again.
        words = f"\n{text}".replace("\n", " \n").split(" ")[1:]
        return b"".join(self.spaced.get(words))[len(self.line_end) :]

    def column(self, texts: pa.Array) -> list[bytes]:
        """What `ids` gives for each text (null: empty), worked out for some MB of them at once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        out: list[bytes] = []
        while len(out) < len(texts):
            at = len(out)
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right"))
            out += self._slice(texts[at : max(to, at + 1)])
        return out

    def _slice(self, texts: pa.Array) -> list[bytes]:
        if self.lower:
            texts = pc.replace_substring(texts, "\n", " ")
            # A to Z come in lower case from here on, unless a mark might compose with the small letter alone.
            # Arrow lowers no texts that lie behind others in their buffer; these are a new one.
            marked = pc.match_substring_regex(texts, "[\u0300-\u036f]")
            cut = pc.split_pattern(pc.if_else(marked, texts, pc.ascii_lower(texts)), " ")
        else:
            # As in `ids`: the first word is taken as the first of a line, here behind an empty word.
            line_end, nothing = pa.scalar("\n", texts.type), pa.scalar("", texts.type)
            lines = pc.binary_join_element_wise(line_end, texts, nothing)
            cut = pc.split_pattern(pc.replace_substring(lines, "\n", " \n"), " ")
        counts = np.diff(cut.offsets.to_numpy())
        words = cut.flatten().dictionary_encode()
        index, words = words.indices.to_numpy(), words.dictionary
        whole = np.ones(len(texts), bool)
        if not self.lower:
            # An empty word or a bare line end stands for white space in a row or at the end.
            odd = pc.is_in(words, pa.array(["", "\n"], words.type))
            odd = pc.or_(odd, pc.match_substring_regex(words, _RARE.pattern)).to_numpy(zero_copy_only=False)[index]
            begins = np.cumsum(counts) - counts
            odd[begins] = False
            whole = ~np.logical_or.reduceat(odd, begins)
            index = index[np.repeat(whole, counts)]
        used = np.zeros(len(words), bool)
        used[index] = True
        values = self._values(words.filter(pa.array(used)))
        ids = np.frombuffer(b"".join(values), self.dtype)
        lengths = np.zeros(len(words), np.int64)
        lengths[used] = np.fromiter(map(len, values), np.int64, len(values)) // ids.itemsize
        starts = np.cumsum(lengths) - lengths
        parts, ends = [], [np.zeros(1, np.int64)]
        for i in range(0, len(index), GATHER):
            some = index[i : i + GATHER]
            n = lengths[some]
            parts.append(ids[spans(starts[some], n)].tobytes())
            ends.append(np.cumsum(n) + ends[-1][-1])
        joined, ends = b"".join(parts), np.concatenate(ends) * ids.itemsize
        bounds = ends[np.concatenate([[0], np.cumsum(counts[whole])])]
        skip = 0 if self.lower else len(self.line_end)
        found = iter([joined[a + skip : b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
        return [next(found) if w else self.ids(t.as_py()) for w, t in zip(whole.tolist(), texts)]

    def _values(self, words: pa.Array) -> list[bytes]:
        """Ids of each word; what stands before the signs at its end is looked up once."""
        bare = pc.utf8_rtrim(words, _SIGNS)
        # Signs after any other character may be of one pre-token with it.
        bare = pc.if_else(pc.match_substring_regex(bare, f"[0-9{_LETTERS}]$"), bare, words)
        ends = pc.not_equal(pc.binary_length(bare), pc.binary_length(words))
        bare = bare.dictionary_encode()
        cache = self.cache if self.lower else self.spaced
        known = cache.get(bare.dictionary.to_numpy(zero_copy_only=False).tolist())
        values = list(map(known.__getitem__, bare.indices.to_numpy().tolist()))
        at = np.flatnonzero(ends.to_numpy(zero_copy_only=False)).tolist()
        signs = [w[len(w.rstrip(_SIGNS)) :] for w in words.filter(ends).to_numpy(zero_copy_only=False).tolist()]
        for i, more in zip(at, self.cache.get(signs)):
            values[i] += more
        return values


# Letters below U+0250 but for the dotted capital I, whose lower case has two characters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_LATIN_WORD = re.compile(f" ?[{_LETTERS}]+\\Z")
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
# Printed ASCII without contractions, and those letters; the pre-tokens of such a chunk.
_PLAIN = re.compile(f" ?[!-&(-~{_LETTERS}]+\\Z")
_PARTS = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[^ 0-9{_LETTERS}]+")
_LOWER_PARTS = re.compile(f"[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# The byte-level alphabet, by byte: those without a printed form take the code points from 256 on.
_UNPRINTED = [b for b in range(256) if b not in set(_PRINTED)]
_BYTE_CHARS = "".join(chr(256 + _UNPRINTED.index(b) if b in _UNPRINTED else b) for b in range(256))

_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, chunks, lower: bool) -> Encoder:
    """One encoder per worker process and vocabulary, so that its words outlive a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, chunks, lower)
    return _ENCODERS[path]


def byte_encoder(path: str) -> Encoder:
    """For byte-level vocabularies that keep case and white space."""
    return _encoder(path, byte_chunks, False)


def word_encoder(path: str) -> Encoder:
    """For vocabularies of lower-cased word pieces that drop white space."""
    return _encoder(path, word_chunks, True)
