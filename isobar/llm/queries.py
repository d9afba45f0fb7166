"""The registered queries of this package, each over its whole table, and comparison SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import (
    ann,
    divergence,
    exact_dedup,
    fim,
    html_text,
    jaccard,
    merge_replay,
    multiset,
    packing,
    repair,
    ring,
    token_counts,
    toxicity,
)
from isobar.llm.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


ORACLES["op1_exact_dedup"] = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""


@_query
def op2_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = repair.write_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return repair.read_documents(files)


_DECIMALS = [str(i) for i in range(1 << 16)]


def _digests(ids: list[np.ndarray], decoded: list[bytes]) -> dict[str, list]:
    def decimals(x):
        return ",".join(map(_DECIMALS.__getitem__, x.tolist())).encode()

    return {
        "n_tokens": [len(x) for x in ids],
        "ids_sha256": [hashlib.sha256(decimals(x)).hexdigest() for x in ids],
        "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded],
    }


@_query
def op3_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_replay.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, _digests, "n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


@_query
def op4_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query
def op5_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op6_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@_query
def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op8_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), n=5, percent=80)


@_query
def op9_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, window=1024).drop("ids")


@_query
def op11_count_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


ORACLES["op11_count_cells"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), words AS (
    SELECT d, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), size AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), used AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (SELECT DISTINCT lang, source FROM docs
), total AS (SELECT lang, source, sum(n) AS total FROM used GROUP BY lang, source
), every AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 1)) // (coalesce(t.total, 0) + s.v) AS p,
           1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (s.lang_total + s.v) AS q
    FROM groups g JOIN size s ON g.lang = s.lang JOIN kept k ON g.lang = k.lang
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
    LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source
), far AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
    FROM every WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""


@_query
def op12_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.compare_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        multiset.printed(F.col("fp")).alias("fingerprint"),
        multiset.printed(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


# Bit b of 64-bit word i of a digest is counted in lane b // 16 of long 16 * i + b % 16.
ORACLES["op12_multiset_hash"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents
), turn AS (
    SELECT doc_id, body, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
           coalesce(lead(body) OVER w, first_value(body) OVER w) AS after
    FROM docs WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), texts AS (
    SELECT doc_id, next_id, body, left(body, length(body) - length(body) // 2) || left(after, length(body) // 2) AS edited
    FROM turn
), parts AS (
    SELECT doc_id, kind, unnest(regexp_extract_all(t, '[^.!?\n]*[.!?\n]+|[^.!?\n]+')) AS part
    FROM (SELECT doc_id, 'own' AS kind, body AS t FROM docs UNION ALL SELECT doc_id, 'edited', edited FROM texts)
), digests AS (SELECT doc_id, kind, sha256(part) AS h, count(*) AS m FROM parts GROUP BY ALL
), counts AS (SELECT doc_id, kind, sum(m)::BIGINT AS n FROM digests GROUP BY ALL
), bits AS (
    SELECT doc_id, kind, i, b, sum(m * ((('0x' || h[16 * i + 16 - b // 4:16 * i + 16 - b // 4])::BIGINT >> (b % 4)) & 1))::BIGINT AS c
    FROM digests, range(4) w(i), range(64) x(b) GROUP BY ALL
), every AS (
    SELECT t.doc_id, k.kind, w.i, x.b, coalesce(c.c, 0) % 16384 AS c, coalesce(n.n, 0) % 16384 AS n
    FROM docs t, (VALUES ('own'), ('edited')) k(kind), range(4) w(i), range(64) x(b)
    LEFT JOIN bits c ON c.doc_id = t.doc_id AND c.kind = k.kind AND c.i = w.i AND c.b = x.b
    LEFT JOIN counts n ON n.doc_id = t.doc_id AND n.kind = k.kind
), prints AS (
    SELECT doc_id, kind, string_agg(printf('%04X', c), '' ORDER BY i, b % 16, b // 16 DESC) || printf('%016X', max(n)) AS fp,
           list(((2 * c - n + 8192 + 16384) % 16384 - 8192) ORDER BY i, b) AS s
    FROM every GROUP BY doc_id, kind
), near AS (
    SELECT t.doc_id, t.body, t.edited, p.fp, e.fp AS edited_fp,
           list_sum(list_transform(range(1, 257), lambda k: p.s[k] * e.s[k])) AS pe,
           list_sum(list_transform(range(1, 257), lambda k: p.s[k] * o.s[k])) AS po,
           list_sum(list_transform(range(1, 257), lambda k: p.s[k] * p.s[k])) AS pp,
           list_sum(list_transform(range(1, 257), lambda k: e.s[k] * e.s[k])) AS ee,
           list_sum(list_transform(range(1, 257), lambda k: o.s[k] * o.s[k])) AS oo, o.fp AS next_fp
    FROM texts t JOIN prints p ON p.doc_id = t.doc_id AND p.kind = 'own'
    JOIN prints e ON e.doc_id = t.doc_id AND e.kind = 'edited'
    JOIN prints o ON o.doc_id = t.next_id AND o.kind = 'own'
)
SELECT doc_id, length(body) AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, edited_fp AS edited_fingerprint,
       CASE WHEN fp = edited_fp THEN 1.0::DOUBLE ELSE coalesce(greatest(2 * pe, 0)::DOUBLE / nullif(pp + ee, 0)::DOUBLE, 0) END AS near_edited,
       CASE WHEN fp = next_fp THEN 1.0::DOUBLE ELSE coalesce(greatest(2 * po, 0)::DOUBLE / nullif(pp + oo, 0)::DOUBLE, 0) END AS near_next
FROM near
"""


@_query
def op13_swar_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents"), seed=1, rate=90, spm_rate=20)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op13_swar_fim"] = """
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents
), d AS (
    SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM t
), c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), s AS (
    SELECT *, array_to_string(units[1:x], '') AS a, array_to_string(units[x + 1:y], '') AS b,
           array_to_string(units[y + 1:], '') AS z
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
                        ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM s
"""


def _pipeline() -> None:
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


_pipeline()
