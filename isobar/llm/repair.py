"""Token files compressed by Re-Pair grammars.

Documents are encoded in ascending order of their identifiers and cut into shards
(ranges of identifiers) and blocks of about BLOCK ids, each of whole documents.
Every block gets a grammar of its own: frequent pairs of ids are replaced by
nonterminals again and again, in rounds that take all sufficiently frequent pairs
at once, left to right without overlap. A block stores its rules, the length each
rule expands to, the sequence that is left, and where its documents begin; any
document can be decoded without expanding the others.

File format: Parquet rows (shard, block, shard_start, doc_ids, lengths, alphabet,
rules, rule_lengths, width, sequence) written by Spark, so any store that Spark
writes to will do. Numbers are little-endian and unsigned. Symbol s below the size
of `alphabet` is the id alphabet[s], the following ones are the rules, which hold
two symbols of 32 bits each; `sequence` holds symbols of `width` bytes.

Defined results: a null or empty text has the end id alone; a null identifier comes
before all others; repeated identifiers stay separate documents; an empty table
gives no blocks. A block holds at least one document, however long.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.base import arrow_map, id_and_text, spans, stage
from isobar.llm.tokens import word_encoder

BLOCK = 1 << 20
ROUNDS = 6
# A pair is worth a rule (two symbols and a length) from this many uses on.
MIN_USES = 8
# Rules of one round, the most frequent pairs first; the rest come in later rounds.
PER_ROUND = 2048

FILE_SCHEMA = (
    "shard int, block int, shard_start long, doc_ids array<long>, lengths array<int>, "
    "alphabet binary, rules binary, rule_lengths binary, width int, sequence binary"
)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


def _slot(codes: np.ndarray) -> np.ndarray:
    mixed = codes.astype(np.uint32) * np.uint32(0x9E3779B1)
    if codes.dtype == np.uint64:
        mixed ^= (codes >> np.uint64(32)).astype(np.uint32) * np.uint32(0x85EBCA77)
    return mixed >> np.uint32(12)


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, rules as an n×2 array, sequence); symbol len(alphabet) + i is rule i."""
    used = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)
    used[ids] = True
    alphabet = np.flatnonzero(used)
    x = (np.cumsum(used) - 1)[ids]
    symbols = len(alphabet)
    rules: list[np.ndarray] = []
    for _ in range(ROUNDS):
        if len(x) < 2:
            break
        # Two symbols make one number, of 32 bits as long as there are few symbols.
        shift, kind = (16, np.uint32) if symbols + PER_ROUND <= 1 << 16 else (32, np.uint64)
        x = x.astype(kind)
        code = (x[:-1] << kind(shift)) | x[1:]
        pairs, uses = _counted(code)
        often = np.flatnonzero(uses >= MIN_USES)
        # Most frequent first, ties by the pair itself.
        often = often[np.argsort(-uses[often], kind="stable")][:PER_ROUND]
        if not len(often):
            break
        chosen = np.sort(pairs[often])
        # A small table of hashes finds the chosen pair of most places; of pairs that share a slot it has one.
        numbers = np.arange(len(chosen), dtype=np.int16)
        slots = _slot(chosen)
        table = np.full(1 << 20, -1, np.int16)
        table[slots] = numbers
        which = table[_slot(code)]
        which[chosen[which] != code] = -1
        for i in np.flatnonzero(table[slots] != numbers).tolist():
            which[code == chosen[i]] = i
        at = np.flatnonzero(which >= 0)
        where = which[at].astype(np.int64)
        # In a run of adjacent places every second one is taken, from the left.
        starts = np.concatenate(([True], np.diff(at) != 1))
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run) % 2 == 0
        # Pairs that overlapping ones left too rare are not replaced.
        worth = np.bincount(where[take], minlength=len(chosen)) >= MIN_USES
        take &= worth[where]
        at, where = at[take], where[take]
        if not len(at):
            break
        number = np.cumsum(worth) - 1
        made = chosen[worth]
        rules.append(np.stack([made >> kind(shift), made & kind((1 << shift) - 1)], 1).astype(np.uint32))
        left = np.ones(len(x), bool)
        left[at + 1] = False
        x[at] = (symbols + number[where]).astype(kind)
        x = x[left]
        symbols += int(worth.sum())
    return alphabet.astype(np.uint32), np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), x


def rule_lengths(letters: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    lengths = np.ones(letters + len(rules), np.int64)
    done = np.arange(len(lengths)) < letters
    while not done.all():
        ready = np.flatnonzero(~done[letters:] & done[rules].all(1))
        lengths[letters + ready] = lengths[rules[ready]].sum(1)
        done[letters + ready] = True
    return lengths[letters:]


class Grammar:
    """Random access into one block."""

    def __init__(self, alphabet: np.ndarray, rules: np.ndarray, lengths: np.ndarray, sequence: np.ndarray):
        letters = len(alphabet)
        self.lengths = np.concatenate([np.ones(letters, np.int64), lengths.astype(np.int64)])
        # The expansions of all symbols behind each other, filled from the shortest rules on.
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.empty(int(self.lengths.sum()), np.int64)
        self.flat[:letters] = alphabet
        rules = rules.astype(np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for same in np.split(order, edges) if len(order) else []:
            for part, offset in ((0, 0), (1, self.lengths[rules[same, 0]])):
                symbols = rules[same, part]
                to = self.begins[letters + same] + offset
                self.flat[spans(to, self.lengths[symbols])] = self._expand(symbols)
        self.sequence = sequence.astype(np.int64)
        self.ends = np.cumsum(self.lengths[self.sequence])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[spans(self.begins[symbols], self.lengths[symbols])]

    def read(self, start: int, length: int) -> np.ndarray:
        """Ids start .. start+length-1, from the symbols that cover them alone."""
        if length <= 0:
            return np.zeros(0, np.int64)
        lo = int(np.searchsorted(self.ends, start, "right"))
        hi = int(np.searchsorted(self.ends, start + length, "left"))
        skip = start - (int(self.ends[lo - 1]) if lo else 0)
        return self._expand(self.sequence[lo : hi + 1])[skip : skip + length]


def write_shards(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, compress and write all documents; gives the files as a frame of blocks."""

    def encode(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc = word_encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        size = len(end)
        block, before, held, names, lengths, parts = 0, 0, 0, [], [], []

        def close():
            alphabet, rules, sequence = compress(np.frombuffer(b"".join(parts), enc.dtype))
            expanded = rule_lengths(len(alphabet), rules)
            width = 2 if len(alphabet) + len(rules) <= 1 << 16 else 4
            return {
                "shard": [shard], "block": [block], "shard_start": [before], "doc_ids": [names], "lengths": [lengths],
                "alphabet": [alphabet.astype("<u4").tobytes()], "rules": [rules.astype("<u4").tobytes()], "rule_lengths": [expanded.astype("<u4").tobytes()], "width": [width], "sequence": [sequence.astype(f"<u{width}").tobytes()],
            }

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), enc.column(batch.column(1))):
                ids += end
                names.append(name)
                lengths.append(len(ids) // size)
                parts.append(ids)
                held += lengths[-1]
                if held >= BLOCK:
                    yield close()
                    block, before, held, names, lengths, parts = block + 1, before + held, 0, [], [], []
        if names:
            yield close()

    ordered = id_and_text(docs, id_col, text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.hash("text"))
    return stage(arrow_map(ordered, encode, FILE_SCHEMA), "repair")


def read_documents(files: DataFrame) -> DataFrame:
    """Every document of the files, decoded alone: doc_id, start, n_tokens, ids_crc32, block_symbols."""
    per_shard = files.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # One row per shard: as many as there were write tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("file_start"))

    def decode(batches):
        for b in batches:
            for row in b.to_pylist():
                alphabet, rules, lengths = (np.frombuffer(row[c], "<u4") for c in ("alphabet", "rules", "rule_lengths"))
                sequence = np.frombuffer(row["sequence"], f"<u{row['width']}")
                grammar = Grammar(alphabet, rules.reshape(-1, 2), lengths, sequence)
                at, starts, crcs = 0, [], []
                for n in row["lengths"]:
                    starts.append(row["file_start"] + row["shard_start"] + at)
                    crcs.append(zlib.crc32(grammar.read(at, n).astype("<u4").tobytes()))
                    at += n
                yield {"doc_id": row["doc_ids"], "start": starts, "n_tokens": row["lengths"], "ids_crc32": crcs}

    return arrow_map(
        files.join(F.broadcast(starts), "shard"), decode, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
