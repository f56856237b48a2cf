import random

import numpy as np
import pytest

from tunelake.llm import bag_minhash, common
from tunelake.llm.common import shingle_hashes, weighted_jaccard, word_hashes

SCHEMA = "doc_id long, text string, class_id string, root string"


def _multiset(rng, n, most):
    return rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(1, most, n)


def test_entries_agree_as_often_as_the_weighted_jaccard_says():
    rng = np.random.default_rng(5)
    for most in (2, 40):
        elements, counts = _multiset(rng, 60, most)
        other = np.where(rng.random(60) < 0.3, rng.integers(1, most + 2, 60), counts)
        agree = np.mean(
            bag_minhash.signature(elements, counts, 20000) == bag_minhash.signature(elements[5:], other[5:], 20000)
        )
        other[:5] = 0
        truth = np.minimum(counts, other).sum() / np.maximum(counts, other).sum()
        assert agree == pytest.approx(truth, abs=0.015)


def test_order_and_single_elements_do_not_matter():
    rng = np.random.default_rng(6)
    elements, counts = _multiset(rng, 30, 9)
    turned = bag_minhash.signature(elements[::-1].copy(), counts[::-1].copy())
    assert (turned == bag_minhash.signature(elements, counts)).all()
    assert np.isfinite(bag_minhash.signature(elements[:1], np.array([1]))).all()


def _corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(900)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    rows, doc = [], 0
    shared = text(120)
    for _ in range(25):  # families of edited copies, at all similarities around the threshold
        base = text(rng.choice([8, 60, 300]))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randrange(10**6)
            rows.append((doc, " ".join(copy)))
            doc += 1
    for _ in range(20):  # one passage in many documents
        rows.append((doc, " ".join(text(90) + shared)))
        doc += 1
    rows += [(doc + 1, "one two"), (doc + 2, "One  two"), (doc + 3, "one"), (doc + 4, "spam " * 400),
             (doc + 5, "spam " * 380), (doc + 6, "spam " * 100)]
    return rows


def _brute_force(rows):
    shingles = {i: shingle_hashes(word_hashes(t)) for i, t in rows}
    root = {i: i for i in shingles}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(shingles)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if weighted_jaccard(shingles[a], shingles[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_classes_equal_those_of_all_pairs(spark):
    rows = _corpus()
    got = bag_minhash.near_copies(spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in got} == _brute_force(rows)


def test_nulls_empty_and_repeated_rows(spark):
    same, other = "a b c d e f g", "q r s t u v w"
    rows = [(1, None), (2, ""), (3, "  \n"), (None, same), (7, same), (7, same), (5, same), (None, "alone"),
            (9, other), (9, same), (20, "x " * 50000)]
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.class_id) for r in bag_minhash.near_copies(docs).collect()), key=str)
    assert got == sorted(
        [(1, 1), (2, 2), (3, 3), (None, 5), (7, 5), (7, 5), (5, 5), (None, None), (9, 5), (9, 5), (20, 20)], key=str
    )
    assert bag_minhash.near_copies(docs.limit(0)).count() == 0


def _shuffled_bytes(plan):
    """Bytes of the rows that the exchanges of a plan have written; reused ones count once."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _shuffled_bytes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _shuffled_bytes(plan.plan())
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(_shuffled_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


def shuffled_bytes(df):
    """The collected rows, and the bytes shuffled for them."""
    rows = df.collect()
    return rows, _shuffled_bytes(df._jdf.queryExecution().executedPlan())


def unrelated(count, words=60):
    rng = random.Random(3)
    return [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))) for i in range(count)]


def test_texts_that_no_pair_names_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(common, "FILTER_ROWS", 512)
    rows = unrelated(1500)
    rows[77] = (77, rows[3][1] + " more")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    pairs = spark.createDataFrame([(3, 77), (4, 5)], "a long, b long")
    found, moved = shuffled_bytes(bag_minhash.links(pairs, docs))
    assert [tuple(r) for r in found] == [(3, 77)] and moved < sum(len(text) for _, text in rows) / 4
    ids = spark.createDataFrame([(3,), (3,), (9,), (5000,)], "doc_id long")
    signed, moved = shuffled_bytes(bag_minhash.signatures(docs, ids))
    assert sorted(r.doc_id for r in signed) == [3, 9] and moved < sum(len(text) for _, text in rows) / 4


def test_signatures_are_written_for_members_of_buckets_with_several_classes_only(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(bag_minhash, "written", lambda df, name: kept.setdefault(name, common.written(df, name)))
    # The second text is too far from the first, which is the smallest member of their bucket.
    first = " ".join(f"w{i}" for i in range(400))
    rows = unrelated(40) + [(50, first), (51, " ".join(f"w{i}" for i in range(122, 400))), (52, None)]
    got = bag_minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i for i, _ in rows}
    assert kept["bag-minhash"].columns == ["doc_id", "low", "high", "bands"]
    assert {r.doc_id for r in kept["signatures"].collect()} == {50, 51}
