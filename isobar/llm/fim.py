"""Fill-in-the-middle: texts cut at two places and put in another order, by SWAR words.

A unit is a run of ASCII letters or any other single code point. The UTF-8 bytes of a
block of documents, as they lie in the Arrow column, are viewed as 64-bit words. Plain
arithmetic on whole words marks every byte that ends a unit; a population count per
word and its running sum tell how many units lie before each word. A cut after k units
is found by searching the running sums for the word and then by counting inside the
word: a multiplication adds up its marks byte by byte, and a subtraction compares all
eight sums at once. No text is decoded or split.

Where a document is cut, and which form it gets, follows from a digest of the seed and
its identifier only:
``h1 .. h4`` are the first four 8-digit groups of the hex sha256 of ``<seed>:<identifier>``.
The prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units, the middle after the
larger. The form is ``plain`` (the text as it is) where h3 % 100 is at least `rate`, else
``spm`` (suffix first) where h4 % 100 is below `spm_rate`, else ``psm``.

Defined results: a null text counts as empty; empty texts and texts that hold one of the
marks are plain; a null identifier counts as no digits; repeated rows are cut alike; a
very long text is a block of its own, with eight bytes of work space for every eight of
text; an empty table gives an empty result. Columns besides the two named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import arrow_map, id_and_text

BLOCK_BYTES = 8 << 20
#: Prefix, suffix and middle mark.
MARKS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_BIT5 = np.uint64(0x2020202020202020)
_ONES = np.uint64(0x0101010101010101)
# Added to a byte below 128 they carry into its high bit from 'a' on, and beyond 'z'.
_FROM_A = np.uint64((0x80 - ord("a")) * 0x0101010101010101)
_PAST_Z = np.uint64((0x7F - ord("z")) * 0x0101010101010101)
_ONE, _SEVEN, _EIGHT, _TOP = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)


def _next_byte(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark moved to the byte before it."""
    out = marks >> _EIGHT
    out[:-1] |= marks[1:] << _TOP
    return out


class Marks:
    """Marked bytes of a buffer with their running count; one high bit a byte."""

    def __init__(self, words: np.ndarray):
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of marks before each byte."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = self.words[np.minimum(word, len(self.words) - 1)] & ((_ONE << (byte * _EIGHT)) - _ONE)
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that holds the k-th mark, from 1."""
        word = np.minimum(np.searchsorted(self.before, k, side="left") - 1, len(self.words) - 1)
        left = (k - self.before[word]).astype(np.uint64)
        # Marks up to and including each byte, eight sums of at most 8 in one word.
        upto = (self.words[word] >> _SEVEN) * _ONES
        # A byte keeps its high bit where its sum is at least what is left.
        there = ((upto | _HIGH) - left * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(there)


def mark_units(data: np.ndarray, ends: np.ndarray) -> tuple[Marks, Marks]:
    """(unit ends, code point starts) of a byte buffer whose length is a multiple of eight.

    `ends` are the places behind the last byte of each text that is not empty.
    """
    w = data.view("<u8")
    folded = (w | _BIT5) & _LOW7
    letter = (folded + _FROM_A) & ~(folded + _PAST_Z) & ~w & _HIGH
    # Continuation bytes are 10xxxxxx.
    inner = w & ~(w << _ONE) & _HIGH
    # A byte ends a unit unless the next one continues its code point or its run of letters.
    stop = ~(_next_byte(inner) | (letter & _next_byte(letter))) & _HIGH
    stop.view(np.uint8)[ends - 1] |= 0x80
    return Marks(stop), Marks(~inner & _HIGH)


def _draws(seed: int, ids: list[int | None]) -> np.ndarray:
    """h1 .. h4 of every identifier."""
    digests = (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(identifiers, bytes padded to whole words, offsets) of about BLOCK_BYTES each."""
    for b in batches:
        ids, texts = b.column(0), b.column(1).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        flat = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(ids):
            to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
            to = min(max(to, at + 1), len(ids))
            lo, hi = int(offsets[at]), int(offsets[to])
            data = np.zeros((hi - lo + 15) // 8 * 8, np.uint8)
            data[: hi - lo] = flat[lo:hi]
            yield ids.slice(at, to - at).to_pylist(), data, offsets[at : to + 1] - lo
            at = to


def transform(
    docs: DataFrame,
    seed: int = 1,
    rate: int = 90,
    spm_rate: int = 20,
    marks: tuple[str, str, str] = MARKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: SCHEMA, `n` units; the lengths in code points are null where plain."""
    p, s, m = (x.encode() for x in marks)

    def run(batches):
        for ids, data, offsets in _blocks(batches):
            start, stop = offsets[:-1], offsets[1:]
            ends, chars = mark_units(data, stop[stop > start])
            first = ends.rank(start)
            n = ends.rank(stop) - first
            h = _draws(seed, ids)
            cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
            # Byte behind the k-th unit; a cut after none lies at the start.
            places = [np.where(k > 0, ends.select(np.maximum(first + k, 1)) + 1, start) for k in cuts.T]
            points = [chars.rank(x) for x in (start, *places)]
            prefix, middle = points[1] - points[0], points[2] - points[1]
            forms, outputs = [], []
            for i, (lo, x, y, hi) in enumerate(zip(start.tolist(), *(z.tolist() for z in places), stop.tolist())):
                text = data[lo:hi].tobytes()
                if not text or h[i, 2] % 100 >= rate or p in text or s in text or m in text:
                    forms.append("plain")
                    outputs.append(text)
                    continue
                a, b, c = text[: x - lo], text[x - lo : y - lo], text[y - lo :]
                spm = h[i, 3] % 100 < spm_rate
                forms.append("spm" if spm else "psm")
                outputs.append(b"".join((s, c, p, a, m, b) if spm else (p, a, s, c, m, b)))
            plain = np.array([f == "plain" for f in forms])
            yield {
                "doc_id": ids,
                "n": n,
                "form": forms,
                "prefix_chars": pa.array(prefix, mask=plain),
                "middle_chars": pa.array(middle, mask=plain),
                "output": pa.array(outputs, pa.binary()).cast(pa.string()),
            }

    return arrow_map(id_and_text(docs, id_col, text_col), run, SCHEMA)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that was cut, from its output and form. No text that was cut holds a mark."""
    parts = F.split(output, "|".join(re.escape(x) for x in marks), -1)
    spm = F.concat(parts[2], parts[3], parts[1])
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)
