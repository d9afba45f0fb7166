"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words and the stems of inflected words is trained in numpy from confirmed toxic texts and
unlabelled ones. With prior π (the share of toxic rows among all labelled rows of
the training part) the risk is

    π E_P[l(f, +)] + max(0, E_U[l(f, -)] - π E_P[l(f, -)])

with the logistic loss l; where the second term would be negative, its gradient is
turned round, so that the classifier unlearns what it overfitted.

The fit sees at most `positives` toxic and `unlabelled` other rows of the labels
table, the ones with the smallest hash of their identifier; the unlabelled rows' own
labels are not looked at. Scores are given to every text.

Defined results: a null or empty text scores by the intercept alone; without a toxic
row to learn from every score is 0; rows with a null label or identifier teach
nothing; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import arrow_append, arrow_map, id_and_text
from isobar.llm.tokens import WordCache

POSITIVES = 3_000
UNLABELLED = 9_000
FEATURES = 8_192
# Share of the toxic texts that a feature is in at least.
SUPPORT = 0.03
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def parts(word: str) -> list[int]:
    """32-bit hashes of the word and of its beginnings, which stand for stems of inflected words."""
    return [
        xxhash.xxh3_64_intdigest(x) & 0xFFFFFFFF for x in (word, *(f"{word[:n]}-" for n in STEMS if len(word) > n))
    ]


_PARTS = WordCache(lambda found: [np.array(parts(w), np.uint32).tobytes() for w in found], limit=300_000)


def features(text: str) -> np.ndarray:
    """Sorted distinct features of a text."""
    return np.unique(np.frombuffer(b"".join(_PARTS.get(list(words(text)))), np.uint32))


@dataclass
class Model:
    """Features with a weight, in rising order, their weights, and the intercept."""

    names: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = float("-inf")

    def score(self, text: str) -> float:
        f = self.bias
        if len(self.names):
            x = features(text)
            at = np.minimum(np.searchsorted(self.names, x), len(self.names) - 1)
            f += float(self.weights[at[self.names[at] == x]].sum())
        return float(1.0 / (1.0 + np.exp(-f))) if f > -500 else 0.0


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the identifier as text leaves 0 when divided by 5."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 5 == 0


def _vocabulary(toxic: list[np.ndarray], other: list[np.ndarray], prior: float) -> np.ndarray:
    """The features of toxic texts, in rising order."""
    names, a = np.unique(np.concatenate(toxic), return_counts=True)
    more, b = np.unique(np.concatenate(other), return_counts=True)
    every = np.union1d(names, more)
    both = np.zeros((2, len(every)))
    both[0, np.searchsorted(every, names)] = a
    both[1, np.searchsorted(every, more)] = b
    # Words of a few copied texts are frequent in no sense that counts.
    often = both[0] >= np.maximum(3, SUPPORT * len(toxic))
    every, both = every[often], both[:, often]
    n, m = len(toxic), len(other)
    share = both.sum(0) / (n + m)
    z = np.abs(both[0] / n - both[1] / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m) + 1e-12)
    # Beyond what the largest of that many chance differences is expected to reach, and in texts
    # that are toxic more often than not: many features of little effect add up in long texts.
    telling = prior * both[0] / n >= 0.5 * both[1] / m
    strong = np.flatnonzero(telling & (z >= np.sqrt(2 * np.log(max(len(every), 2)))))
    strong = strong[np.argsort(-z[strong], kind="stable")][:FEATURES]
    return np.sort(every[strong])


class _Sparse:
    def __init__(self, texts: list[np.ndarray], names: np.ndarray):
        self.n, self.m = len(texts), len(names)
        rows, cols = [], []
        for i, x in enumerate(texts):
            at = np.minimum(np.searchsorted(names, x), max(len(names) - 1, 0))
            hit = at[names[at] == x] if len(names) else at[:0]
            cols.append(hit)
            rows.append(np.full(len(hit), i))
        self.rows, self.cols = np.concatenate(rows), np.concatenate(cols)

    def times(self, w):
        return np.bincount(self.rows, weights=w[self.cols], minlength=self.n)

    def back(self, g):
        return np.bincount(self.cols, weights=g[self.rows], minlength=self.m)


def nonnegative_pu(
    toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4
) -> Model:
    """Full-batch Adam on the non-negative risk."""
    if not toxic or not unlabelled:
        return Model()
    names = _vocabulary(toxic, unlabelled, prior)
    p, u = _Sparse(toxic, names), _Sparse(unlabelled, names)
    w, bias = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for t in range(1, rounds + 1):
        fp, fu = p.times(w) + bias, u.times(w) + bias
        # Slopes of the logistic loss: for a toxic target and for a clean one.
        up, down_p, down_u = -sigmoid(-fp) / p.n, sigmoid(fp) / p.n, sigmoid(fu) / u.n
        clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if clean >= 0:
            gp, gu = prior * up - prior * down_p, down_u
        else:
            gp, gu = prior * down_p, -down_u
        grad = np.append(p.back(gp) + u.back(gu) + decay * w, gp.sum() + gu.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        step = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    return Model(names, w, float(bias))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Model:
    """Learn from the rows that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    )
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return Model()
    mixed = F.xxhash64(F.lit("sample"), "doc_id")
    drawn = (
        known.where("toxic = 1").select("doc_id", F.lit(1).alias("part")).orderBy(mixed, "doc_id").limit(positives)
        .union(known.select("doc_id", F.lit(0).alias("part")).orderBy(mixed, "doc_id").limit(unlabelled))
    )

    def shorten(batches):
        for b in batches:
            yield {"part": b.column(0), "found": [features(t.as_py()).tobytes() for t in b.column(1)]}

    # At most positives + unlabelled identifiers are broadcast, and as many feature sets come back.
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id").select("part", "text")
    sets = sorted((r["part"], bytes(r["found"])) for r in arrow_map(texts, shorten, "part int, found binary").collect())
    toxic, other = ([np.frombuffer(x, np.uint32) for p, x in sets if p == part] for part in (1, 0))
    return nonnegative_pu(toxic, other, min(float(prior), 0.99))


def scored(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score") -> DataFrame:
    """All columns of docs and the score of the text."""
    state = docs.sparkSession.sparkContext.broadcast(model)
    return arrow_append(docs, text_col, lambda texts: {score: [state.value.score(t) for t in texts]}, f"`{score}` double")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit(docs, labels, id_col, text_col)
    return scored(id_and_text(docs, id_col, text_col), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    model = fit(docs, labels, id_col, text_col)
    return scored(docs, model, text_col, "_score").where(F.col("_score") < 0.5).drop("_score")
