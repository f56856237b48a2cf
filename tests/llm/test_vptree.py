from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import queries, vptree
from tunelake.llm.vptree import Found, Queries

SCHEMA = "vec_id long, embedding array<float>, label int, score string"
SF = "/root/testdata/sf0.001"


def _brute_force(rows, wanted, count):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(np.float64)
    found = {}
    for query in sorted({i for i in ids.tolist() if wanted(i)}):
        scores = vectors @ vectors[ids == query][0]
        order = sorted((-round(float(s), 12), i) for s, i in zip(scores, ids.tolist(), strict=True) if i != query)
        found[query] = [i for _, i in order[:count]]
    return found


def _got(result):
    got = {}
    for row in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(row.query_id, []).append(row.vec_id)
    return got


def _exact(ids, vectors, count):
    """Neighbours by whole-number arithmetic on the exact values of the components."""
    whole = [[Fraction(x) for x in v] for v in vectors.tolist()]
    found = []
    for i, q in zip(ids.tolist(), whole, strict=True):
        scores = sorted((-sum(x * y for x, y in zip(q, p, strict=True)), j) for j, p in zip(ids.tolist(), whole, strict=True) if j != i)
        found.append(scores[:count])
    return found


def _searched(points, ids, asked, count, relax=1.0):
    kept = Found(Queries(np.arange(len(asked)), ids[asked], points[asked]), count)
    half = len(ids) // 2
    made = kept.search(ids[:half], points[:half], relax) + kept.search(ids[half:], points[half:], relax)
    return kept.rows().groupby("query")["vec_id"].apply(list).to_dict(), made


def _clusters(seed, count, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, size)) * 3
    return centres[rng.integers(0, 40, count)] + 0.1 * rng.standard_normal((count, size))


@pytest.mark.parametrize("longer", [1.0, 1e4, 1e8, 1e150, 1e200, 1e300])
def test_one_long_vector_changes_no_other_neighbour(longer, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    rng = np.random.default_rng(3)
    points = rng.standard_normal((160, 6))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[77] *= longer
    points[5] /= longer
    ids = np.arange(160)
    found, _ = _searched(points, ids, ids, 7)
    for query, wanted in enumerate(_exact(ids, points, 7)):
        scores = {j: -s for s, j in wanted}
        got = [scores.get(j) for j in found[query]]
        # Other neighbours than the exact ones only where scores differ in the last bits.
        last = -wanted[-1][0]
        assert all(s is not None or abs(sum(Fraction(x) * Fraction(y) for x, y in zip(points[query].tolist(), points[j].tolist(), strict=True)) - last) <= Fraction(1, 10**13) * max(1, abs(last)) for s, j in zip(got, found[query], strict=True))


def test_products_beyond_double_precision():
    a = np.array([[1e200, 1e200], [1e200, -1e200], [1e308, 1e308], [3.0, 4.0], [1e200, 1e200]])
    b = np.array([[1e200, 1e200], [1e200, 1e200], [1e-300, 1e-300], [1.0, 0.5], [-1e200, -1e200]])
    assert vptree.inner_products(a, b).tolist() == [np.inf, 0.0, pytest.approx(2e8), 5.0, -np.inf]


def test_clusters_are_pruned_and_larger_factors_prune_more(monkeypatch):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 32)
    points = _clusters(0, 4000)
    points[100:400] = points[100]
    ids, asked = np.arange(4000), np.arange(0, 4000, 20)
    exact, made = _searched(points, ids, asked, 10)
    scores = points[asked] @ points.T
    for place, query in enumerate(asked.tolist()):
        order = sorted((-round(float(s), 10), i) for i, s in enumerate(scores[place]) if i != query)
        assert [i for _, i in order[:10]] == exact[place] or np.allclose(
            scores[place][exact[place]], [-s for s, _ in order[:10]], atol=1e-9
        )
    relaxed, fewer = _searched(points, ids, asked, 10, 1.1)
    recall = np.mean([len(set(exact[k]) & set(relaxed[k])) / 10 for k in exact])
    assert fewer < made < 0.6 * len(asked) * 4000 and recall >= 0.9


def test_equals_brute_force_over_several_shards_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 60)
    monkeypatch.setattr(vptree, "ROUND_NUMBERS", 90)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).round(2).tolist()) for i in range(300)]
    rows[50:120] = [(i, rows[50][1]) for i in range(50, 120)]  # ties beyond a query's neighbours
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    result = vptree.nearest(table, F.col("vec_id") % 10 == 0, 20)
    assert _got(result) == _brute_force(rows, lambda i: i % 10 == 0, 20)


def test_vectors_of_two_sizes_and_repeated_ids(spark):
    rows = [(10, [1.0, 0.0]), (10, [0.0, 1.0]), (20, [1.0, 0.0, 0.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0]), (3, [0.0, 0.0, 5.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = sorted(map(tuple, vptree.nearest(table, F.col("vec_id") % 10 == 0).collect()))
    assert found == [(10, 1, 1, 2.0), (10, 1, 2, 3.0), (10, 2, 1, 1.0), (10, 2, 2, 1.0), (20, 1, 3, 0.0)]
    with pytest.raises(ValueError):
        vptree.nearest(table, F.lit(True), relax=0.5)


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SF, "embeddings").collect()]
    result = queries.op8_vantage_point_trees(spark, SF)
    assert _got(result) == _brute_force(rows, lambda i: i % 20 == 0, 20)
    vectors = dict(rows)
    row = result.first()
    dot = float(np.dot(np.array(vectors[row.query_id], np.float64), np.array(vectors[row.vec_id], np.float64)))
    assert row.score == pytest.approx(dot, abs=1e-14)


def test_rows_that_take_no_part(spark):
    rows = [(20, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [2.0, 0.0]), (8, [2.0, 5.0]),
            (40, [0.0, 1.0]), (20, [1.0, 0.0]), (8, [2.0, 5.0]), (9, [])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    result = vptree.nearest(table, F.col("vec_id") % 20 == 0, 20)
    assert {tuple(r)[:3] for r in result.where("query_id = 40").collect()} == {
        (40, 1, 8), (40, 2, 8), (40, 3, 7), (40, 4, 20), (40, 5, 20)
    }
    assert vptree.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vptree.nearest(table, F.lit(False)).count() == 0
