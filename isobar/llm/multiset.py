"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A text is cut into paragraphs: lines, and within a line what ends with a full stop,
exclamation or question mark, so that a text of one line has parts too. Every character
lies in one paragraph. The sha256 of a paragraph is a wide vector of LANES bits; the
fingerprint holds, for every lane, the number of paragraphs with that bit modulo 2**14,
and the number of paragraphs modulo 2**14. Sums don't depend on order, and paragraphs can
be put in and taken out again without the text.

Each long holds four lanes of 16 bits. The two upper bits of a lane take its carry and are
cleared after each sum, so no lane reaches into the next and no sum leaves 64 bits.

A lane minus half the paragraphs is a sum of random signs. The products of two such
vectors estimate how many paragraphs two texts share, and the squares of one how many it
has: `likeness` is ``2 ab / (aa + bb)``, at least 0. Equal multisets give 1; texts without
common paragraphs give 0 up to an error of about ``1 / sqrt(LANES)``.

All of it is built-in column functions. A document meets the next one in descending
order of identifiers within blocks of that order: a range shuffle of keys alone finds
where blocks begin, and the first row of a block is also sent to the block before.

Defined results: a null text counts as empty and has no paragraphs; two empty texts are
alike by 1; null identifiers come last; of equal identifiers the order is that of a hash
of their texts, then of the texts; with a single document it is its own next; very long texts are
cut like others; counts that wrap cost likeness nothing unless one paragraph occurs thousands
of times; an empty table gives an empty
result. Columns besides the two named are not read. Rows that repeat identifier and text
lie in one block, which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.base import id_and_text

LANES = 256
WORDS = LANES // 64
PARAGRAPHS = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
#: Bytes of text and number of rows a block should hold, and the number of blocks at most.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 50_000
BLOCKS = 1 << 16

BITS = 14
_MOD = (1 << BITS) - 1
_UNIT = 0x0001000100010001
_LOW, _CARRY = _UNIT * _MOD, _UNIT << BITS


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARAGRAPHS), 0)


def _vector(paragraph: Column) -> Column:
    """The bits of a paragraph's sha256, as WORDS longs."""
    digest = F.sha2(paragraph, 256)

    def half(at):
        return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")

    return F.array(*[F.shiftleft(half(16 * i + 1), 32).bitwiseOR(half(16 * i + 9)) for i in range(WORDS)])


def _add(a: Column, b: Column) -> Column:
    """Four lanes plus four lanes."""
    return (a + b).bitwiseAND(F.lit(_LOW))


def _subtract(a: Column, b: Column) -> Column:
    return (a.bitwiseOR(F.lit(_CARRY)) - b).bitwiseAND(F.lit(_LOW))


def _lanes(vector: Column, at: Column) -> Column:
    """The bits of a vector that long number `at` of the fingerprint counts, one in each lane."""
    word = vector[F.shiftright(at, 4)]
    # The shift is a column, which only the SQL name of the function takes.
    return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(15))).bitwiseAND(F.lit(_UNIT))


def _sum(vectors: Column) -> Column:
    none = F.array_repeat(F.lit(0).cast("long"), 16 * WORDS)
    return F.aggregate(vectors, none, lambda held, v: F.transform(held, lambda x, i: _add(x, _lanes(v, i))))


def of_paragraphs(parts: Column) -> Column:
    """Fingerprint of an array of paragraphs: the longs of lanes and, last, the number of paragraphs."""
    count = F.size(parts).cast("long").bitwiseAND(F.lit(_MOD))
    return F.concat(_sum(F.transform(parts, _vector)), F.array(count))


def fingerprint(text: Column) -> Column:
    return of_paragraphs(paragraphs(F.coalesce(text, F.lit(""))))


def insert(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both; b may be that of one paragraph."""
    return F.zip_with(a, b, _add)


def delete(a: Column, b: Column) -> Column:
    """Fingerprint of a without the paragraphs of b."""
    return F.zip_with(a, b, _subtract)


def printed(fp: Column) -> Column:
    """Hex digits: 16 a long, four a lane; the count's last four are not zero."""
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _signs(fp: Column) -> Column:
    """Each lane twice less the count, as a number from -2**13 to 2**13 - 1."""
    count = fp[16 * WORDS]

    def signed(x, at):
        lane = F.shiftrightunsigned(x, at).bitwiseAND(F.lit(_MOD))
        half = 1 << (BITS - 1)
        return (lane * 2 - count + half).bitwiseAND(F.lit(_MOD)) - half

    longs = F.slice(fp, 1, 16 * WORDS)
    return F.flatten(F.transform(longs, lambda x: F.array(*[signed(x, at) for at in (0, 16, 32, 48)])))


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def _likeness(a: Column, b: Column, ab: Column, aa: Column, bb: Column) -> Column:
    near = F.try_divide(F.greatest(ab * 2, F.lit(0).cast("long")).cast("double"), (aa + bb).cast("double"))
    return F.when(a == b, 1.0).otherwise(F.coalesce(near, F.lit(0.0)))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints, from 0 to 1."""
    x, y = _signs(a), _signs(b)
    return _likeness(a, b, _product(x, y), _product(x, x), _product(y, y))


def _order_key(doc_id: Column, text: Column) -> Column:
    """Ascending by this text is descending by identifier, nulls last, then by a hash of the text."""

    def digits(x):
        return F.lpad(F.hex(x.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")

    return F.concat(F.coalesce(digits(F.bitwise_not(doc_id)), F.lit("G" * 16)), digits(F.xxhash64(text)))


def _cuts(keys: DataFrame, blocks: int) -> list[str]:
    """First key of each of about `blocks` equal ranges, ascending."""
    ranges = keys.repartitionByRange(blocks, "key").groupBy(F.spark_partition_id()).agg(F.min("key"))
    return sorted(r[1] for r in ranges.collect())


def _in_blocks(rows: DataFrame, cuts: list[str]) -> DataFrame:
    """Rows with `block`, the first of each block again in the block before, with `guest`.

    The block is found in two steps: among every so many cuts, then among those between.
    """
    step = max(1, int(len(cuts) ** 0.5))
    spans = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.split(F.lit(",".join(s[0] for s in spans)), ",")
    inner = F.transform(F.split(F.lit(";".join(",".join(s) for s in spans)), ";"), lambda s: F.split(s, ","))
    key = F.col("key")
    rows = rows.withColumn("_span", F.size(F.filter(heads, lambda c: c <= key)) - 1)
    rows = rows.withColumn("_inside", F.filter(inner[F.col("_span")], lambda c: c <= key))
    block = F.col("_span") * step + F.size("_inside") - 1
    homes = F.array(F.struct(block.alias("block"), F.lit(False).alias("guest")))
    before = F.struct(F.pmod(block - 1, F.lit(len(cuts))).alias("block"), F.lit(True).alias("guest"))
    first = F.element_at("_inside", -1) == key
    homes = F.when(first, F.concat(homes, F.array(before))).otherwise(homes)
    return rows.select("*", F.inline(homes)).drop("_span", "_inside")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, fp, and next_text, next_fp of the next document by descending identifier."""
    rows = id_and_text(docs, id_col, text_col).withColumn("key", _order_key(F.col("doc_id"), F.col("text")))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if not count:
        cuts = ["0"]
    else:
        cuts = _cuts(rows.select("key"), min(BLOCKS, max(1, size // BLOCK_BYTES, count // BLOCK_ROWS)))
    held = _in_blocks(rows.withColumn("fp", fingerprint(F.col("text"))), cuts)
    order = Window.partitionBy("block").orderBy("guest", "key", "text")
    follower = F.lead(F.struct("text", "fp")).over(order)
    return (
        held.withColumn("_next", follower)
        .where("not guest")
        .select("doc_id", "text", "fp", F.col("_next.text").alias("next_text"), F.col("_next.fp").alias("next_fp"))
    )


def edited(text: Column, following: Column) -> Column:
    """The last half of a text, rounded down, replaced by as much of the start of another, or all of it."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def compare_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints (arrays of longs) of every text and of its edited text, and their likenesses."""
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    signs = {f"_{c}": _signs(F.col(c)) for c in ("fp", "edited_fp", "next_fp")}
    rows = rows.withColumns(signs)
    rows = rows.withColumns({f"_{c}2": _product(F.col(f"_{c}"), F.col(f"_{c}")) for c in ("fp", "edited_fp", "next_fp")})

    def near(c):
        ab = _product(F.col("_fp"), F.col(f"_{c}"))
        return _likeness(F.col("fp"), F.col(c), ab, F.col("_fp2"), F.col(f"_{c}2"))

    return rows.select(
        "doc_id", "text", "edited", "fp", "edited_fp", near("edited_fp").alias("near_edited"), near("next_fp").alias("near_next")
    )
