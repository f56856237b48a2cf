import random
import zlib

import numpy as np
import pandas as pd
import pytest

from tunelake.llm import common, queries, toxicity

SF = "/root/testdata/sf0.01"


def _recursive(values, offset=0):
    """All maximal scoring segments by their definition: the best one, then the same on both sides of it."""
    best = max(
        ((sum(values[i:j]), i - j, -i, i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    i, j = best[3], best[4]
    # Of equal sums the shortest is taken: leading and trailing parts of sum 0 do not belong to a segment.
    i, j = min(
        ((a, b) for a in range(len(values)) for b in range(a + 1, len(values) + 1) if sum(values[a:b]) == best[0]),
        key=lambda s: (s[1] - s[0], s[0]),
    )
    return _recursive(values[:i], offset) + [(offset + i, offset + j, best[0])] + _recursive(values[j:], offset + j)


def test_segments_equal_their_definition():
    rng = random.Random(2)
    for _ in range(300):
        values = [rng.choice([-3.7, -2.2, -1.1, -0.6, 0.9, 1.3, 2.6, 4.1]) + rng.random() for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(values))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in _recursive(values)]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in _recursive(values)])


def test_extreme_rate_solves_its_equation():
    scores, shares = np.array([-1.0, -0.5, 2.0]), np.array([0.7, 0.25, 0.05])
    rate = toxicity.extreme_rate(scores, shares)
    assert (shares * np.exp(rate * scores)).sum() == pytest.approx(1.0) and rate > 0
    assert toxicity.extreme_rate(np.array([-1.0]), np.array([1.0])) == 1.0


def test_prior_holds_rare_features_back():
    corpus = np.array([5000.0, 3.0, 60.0, 0.0, 5000.0])
    toxic, clean = np.array([500.0, 1, 50, 0, 480]), np.array([4500.0, 0, 0, 0, 4520])
    odds = toxicity.cautious_odds(corpus, toxic, clean, (corpus.sum(), toxic.sum(), clean.sum()), 5)
    assert odds[2] > 3 and 0 <= odds[1] < toxicity.DRIFT and odds[3] == 0 and abs(odds[0]) < 0.5


def test_features_and_scores_of_tokens():
    pieces = ["Nasty,", "nasty", "...", "a", "nastyness", "日本語の本", "aaaaaaa", "😀" * 300, "x" * 5000]
    number, bucket = toxicity.token_features(toxicity._words(pieces))
    by = {k: set(bucket[number == k].tolist()) for k in range(len(pieces))}
    assert by[0] == by[1] and not by[2] and len(by[3]) == 1
    assert len(by[1] & by[4]) == 2  # ^nast and nasty
    assert [len(by[k]) for k in (1, 6)] == [4, 4]  # the word, and its different grams
    scores = np.arange(toxicity.BUCKETS, dtype=np.float32)
    wanted = [max(by[k], default=0) - toxicity.DRIFT for k in range(len(pieces))]
    assert toxicity.token_scores(pieces, scores).tolist() == wanted
    assert toxicity.token_scores([], scores).tolist() == []


@pytest.mark.parametrize("most", [0, 3, 100])
def test_counts_equal_plain_counts(monkeypatch, most):
    texts = ["a b a nasty", None, "", "b b c", "nasty nasty words", "c"]
    monkeypatch.setattr(common, "CHUNK_CHARS", 5)
    monkeypatch.setattr(common, "REMEMBERED_SPANS", most)
    batch = pd.DataFrame({"text": texts, "toxic": pd.array([1, 1, 0, None, 0, None], "Int64")})
    [found] = toxicity._counted([batch])
    plain = {}
    for text, toxic in zip(texts, [1, 1, 0, None, 0, None], strict=True):
        for token in set((text or "").split()):
            for own in toxicity.token_features([token])[1].tolist():
                line = plain.setdefault(own, [0, 0, 0])
                line[0] += 1
                if toxic is not None:
                    line[1 if toxic else 2] += 1
    assert {row[0]: list(row[1:]) for row in found.itertuples(index=False)} == plain


def test_probability_is_recomputed_plainly():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), rate=0.7, volume=0.2, weights=np.array([-3.0, 1.1, 0.4]))
    scores = np.array([-1.0, 6.0, -0.5, 4.0, -9.0, 1.0, -1.0])
    found = model.passages(scores)
    assert [(a, b) for a, b, *_ in found] == [(1, 4), (5, 6)]
    expected = [0.2 * 7 * np.exp(-0.7 * s) for s in (9.5, 1.0)]
    assert [e for *_, e in found] == pytest.approx(expected)
    best, strong = -np.log(expected[0]), sum(-np.log(e) for e in expected if e < toxicity.SIGNIFICANT)
    wanted = 1 / (1 + np.exp(-(-3.0 + 1.1 * best + 0.4 * np.log1p(strong))))
    assert model.probability(model.evidence(found)) == pytest.approx(wanted)
    assert model.evidence([]) == (-5.0, 0.0)


def test_logistic_regression_is_the_optimum():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    truth = (x @ [1.5, -1.0] + rng.normal(size=300) > 0.3).astype(float)
    w = toxicity.logistic(x, truth)
    full = np.column_stack([np.ones(300), x])
    slope = full.T @ (1 / (1 + np.exp(-full @ w)) - truth) + np.diag([0, 0.03, 0.03]) @ w
    assert np.abs(slope).max() < 1e-5


def _auc(score, truth):
    order = np.argsort(np.argsort(score)) + 1
    positive = truth.sum()
    return (order[truth].sum() - positive * (positive + 1) / 2) / (positive * (~truth).sum())


def test_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, SF, "labels").collect()}
    got = queries.op9_toxicity(spark, SF).collect()
    assert len(got) == queries.table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.score, labels[r.doc_id] == 1) for r in got if r.held_out and r.doc_id in labels]
    assert _auc(np.array([s for s, _ in held]), np.array([t for _, t in held])) > 0.9


DOCS = "doc_id long, text string, score string, toxic string"
LABELS = "doc_id long, toxic int, text string"


def _small():
    rng = random.Random(8)
    words = ["plain", "words", "that", "say", "little", "of", "note", "and", "more"]
    docs, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if i % 4 == 0:
            text[10:10] = ["awful,", "NASTY", "awfulness"]
        docs.append((i, " ".join(text), "clash", None))
        labels.append((i, int(i % 4 == 0), "clash"))
    return docs, labels


def test_passages_and_defined_results(spark):
    docs, labels = _small()
    odd = [(900, None, None, None), (901, "", None, None), (None, "plain awful nasty words", None, None),
           (902, "!! ... ##", None, None), (903, "plain " * 40000 + "awful nasty awful", None, None)]
    labels += [(None, 1, None), (3, None, None), (5, 0, None)]
    given = spark.createDataFrame(docs, DOCS)
    model = toxicity.learn(given, spark.createDataFrame(labels, LABELS))
    found = toxicity.scored(given.unionByName(spark.createDataFrame(odd, DOCS)), model)
    assert found.columns == ["doc_id", "text", "toxic", "score", "passages"]
    got = {r.doc_id: r for r in found.collect()}
    for i, text, *_ in docs:
        assert (got[i].score >= 0.7) == (i % 4 == 0)
        if i % 4 == 0:
            passage = max(got[i].passages, key=lambda p: p.score)
            assert passage.first_token <= 10 and passage.end_token >= 13
    assert got[900].score == got[901].score < 0.3 and not got[900].passages
    assert got[902].score < 0.3 and got[None].score > 0.7
    assert got[903].passages[0].first_token == 40000


def test_hot_ids_and_long_texts_do_not_reach_the_driver(spark):
    docs, labels = _small()
    hot = [(4, "plain " * 3000 + "awful nasty awful", None, None)] * 200
    given = spark.createDataFrame(docs + hot, DOCS).repartition(6)
    model = toxicity.learn(given, spark.createDataFrame(labels, LABELS))
    found = toxicity.scored(given, model).where("doc_id = 4").select("score").collect()
    assert len(found) == 201 and all(row.score > 0.7 for row in found)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None, None)], DOCS)
    model = toxicity.learn(docs, spark.createDataFrame([(1, 0, None)], LABELS))
    assert model is None and toxicity.scored(docs, model).first().score == 0.0
    docs, labels = _small()
    given = spark.createDataFrame(docs, DOCS)
    model = toxicity.learn(given, spark.createDataFrame(labels, LABELS))
    assert toxicity.scored(given.limit(0), model).count() == 0
