import hashlib
import random
from collections import defaultdict

import pytest

from isobar.llm import exact_dedup as ed


def brute(rows, keep):
    """(doc_id, keep_id, size, kept, digest) by a plain dictionary."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        owner = keep(known) if known else None
        left = True
        for i in sorted(ids, key=repr):
            out.append((i, owner, len(ids), left and i == owner, hashlib.sha256(key).hexdigest()))
            left = left and i != owner
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,fn", [("largest", max), ("smallest", min)])
def test_against_brute_force(odd, keep, fn):
    got = ed.exact_groups(odd, keep=keep).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute([(r.doc_id, r.text) for r in odd.collect()], fn)


def test_empty(none):
    assert ed.exact_groups(none).count() == 0
    assert ed.drop_copies(none).columns == none.columns


def test_rows_that_stay(odd):
    kept = ed.drop_copies(odd, keep="largest")
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 4, 5, 6, 7, None, 9, 10], key=repr)


@pytest.mark.parametrize("limit", [1 << 30, 20_000, 1_000])
def test_trie_spills_by_subtree(limit):
    rng = random.Random(limit)
    head = b"a common beginning of many keys " * 4
    keys = [head[: rng.randrange(len(head))] + bytes(rng.choices(b"ab", k=rng.randrange(9))) for _ in range(3_000)]
    keys += [b"", b"", head, head + b"x"]
    want = defaultdict(list)
    for i, k in enumerate(keys):
        want[k].append(i)
    records = [(k, i, 1, hashlib.sha256(k).digest()) for i, k in enumerate(keys)]
    got = list(ed.owners_of(records, ed._rank("smallest"), limit))
    assert sorted(got) == sorted((min(v), len(v), hashlib.sha256(k).digest()) for k, v in want.items())


def test_hot_text_reaches_its_partition_once_per_task(spark):
    docs = spark.range(4_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text").repartition(4)
    groups = ed.exact_groups(docs, keep="largest")
    assert groups.where("kept").count() == docs.select("text").distinct().count()
    assert groups.where("group_size > 1").count() == 1334
