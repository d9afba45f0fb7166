import random
import zlib

import numpy as np
import pytest

from isobar.llm import toxicity as tox


def corpus(seed=1, n=700, toxic=0.12):
    """(doc_id, text, toxic): bad words and inflected bad stems make texts toxic."""
    rng = random.Random(seed)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("ran", "lin", "tos", "mer")]
    bad = ["nasty", "vile", *(f"horri{x}" for x in ("d", "ble", "fying", "fies", "fied"))]
    out = []
    for i in range(n):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        mark = rng.random() < toxic
        if mark:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(bad)
        out.append((i, " ".join(text).capitalize() + ".", int(mark)))
    return out


def frames(spark, rows, labelled=0.6):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string").repartition(3)
    known = [(i, 1, y) for i, _, y in rows if random.Random(i).random() < labelled]
    return docs, spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark):
    docs, labels = frames(spark, corpus())
    got = {r.doc_id: r for r in tox.score_documents(docs, labels).collect()}
    truth = {i: y for i, _, y in corpus()}
    assert len(got) == len(truth)
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {i for i, r in got.items() if r.held_out} == held
    right = [got[i].predicted == truth[i] for i in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_teach_nothing(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    lied = spark.createDataFrame(
        [(r.doc_id, 1, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic) for r in labels.collect()],
        labels.schema,
    )
    a, b = (sorted(map(tuple, tox.score_documents(docs, x).collect())) for x in (labels, lied))
    assert a == b


def test_rows_that_stay(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    kept = tox.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    clean = {i for i, _, y in rows if not y}
    assert len(clean - left) <= 0.02 * len(clean) and len(left - clean) <= 0.2 * (len(rows) - len(clean))


def test_odd_rows(spark, odd, none):
    _, labels = frames(spark, corpus())
    more = labels.union(spark.createDataFrame([(None, 1, 1), (5, 1, None), (5, 1, 7)], labels.schema))
    got = tox.score_documents(odd, more)
    assert got.count() == odd.count()
    assert tox.score_documents(none, labels).count() == 0
    nothing = labels.where("toxic = 0")
    assert {r.predicted for r in tox.score_documents(odd, nothing).collect()} == {0}
    assert {r.score for r in tox.score_documents(odd, labels.where("false")).collect()} == {0.0}


def test_risk_does_not_go_below_zero():
    """With few positives and many parameters the plain unlabelled risk would turn negative."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    toxic = [tox.features(" ".join(rng.sample(words[:30], 10))) for _ in range(40)]
    other = [tox.features(" ".join(rng.sample(words, 15))) for _ in range(300)]
    model = tox.nonnegative_pu(toxic, other, 0.2)
    assert np.isfinite(model.weights).all() and np.isfinite(model.bias)


@pytest.mark.parametrize("text", ["", " ", "123 456", "x" * 100_000])
def test_scores_of_odd_texts(text):
    model = tox.Model(np.array([5], np.uint32), np.array([1.0]), -2.0)
    assert 0 <= model.score(text) <= 1
