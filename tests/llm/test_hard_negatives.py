import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import hard_negatives as mining
from tunelake.llm.hard_negatives import Anchors, Negatives, Positives, Rule, hard_negatives, products, quantised, walk

def anchors():
    return F.col("vec_id") % 10 == 0



def plain(rows, rule=Rule(), every=10):
    """All pairs, as ``rows (vec_id, label, vector)`` of Python numbers."""
    found = []
    rows = [row for row in rows if None not in row and None not in row[2]]
    anchors = {(row[0], row[1], tuple(row[2])) for row in rows if row[0] % every == 0}
    for anchor, label, vector in anchors:
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v, strict=True)), i, lab) for i, lab, v in rows
            if i != anchor and len(v) == len(vector)
        )
        scored = [(max(-(2**63 - 1), min(2**63 - 1, -s)), i, lab) for s, i, lab in scored]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for best, positive, _ in [x for x in scored if x[2] == label][:rule.positives]:
            within = [
                (s, i) for s, i, lab in scored
                if lab != label and rule.least_percent * best <= 100 * s <= rule.most_percent * best
            ]
            found += [(anchor, positive, rank, i, best, s) for rank, (s, i) in enumerate(within[:rule.negatives], 1)]
    return sorted(found)


def clustered_rows(seed, count, size=6, spread=40, labels=3, scale=100):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size)) * scale
    vectors = np.floor(centres[rng.integers(0, 4, count)] + rng.normal(size=(count, size)) * spread).astype(np.int64)
    return [(int(i), int(rng.integers(0, labels)), vectors[i].tolist()) for i in range(count)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")


def mined(spark, rows, rule=Rule()):
    return sorted(map(tuple, hard_negatives(frame(spark, rows), anchors(), rule).collect()))


@pytest.mark.parametrize("given", [
    clustered_rows(1, 250), clustered_rows(2, 250, spread=400), clustered_rows(3, 200, size=2, spread=3, scale=4),
    clustered_rows(4, 120, labels=1), clustered_rows(5, 40, labels=8),
])
def test_equals_all_pairs(spark, given):
    assert mined(spark, given) == plain(given)


def test_other_rules_and_rounds(spark, monkeypatch):
    given, rule = clustered_rows(6, 200), Rule(2, 3, 50, 99)
    monkeypatch.setattr(mining, "ROUND_NUMBERS", 40)
    assert mined(spark, given, rule) == plain(given, rule)


def test_rows_that_take_no_part_and_repeated_rows(spark):
    given = clustered_rows(7, 120)
    given += [given[0]] * 40 + [given[5]] * 3 + [(10, 2, given[11][2]), (10, 1, [0] * 6)]
    odd = [(None, 1, [1] * 6), (130, None, [1] * 6), (140, 1, None), (150, 1, [1, None, 1, 1, 1, 1]), (160, 1, [1, 2])]
    found = mined(spark, given + odd)
    assert found == plain(given + odd)
    extra = frame(spark, given).withColumns({"rank": F.lit("x"), "anchor": F.lit(None).cast("int")})
    assert sorted(map(tuple, hard_negatives(extra, anchors()).collect())) == plain(given)


def test_large_and_zero_vectors(spark):
    given = clustered_rows(8, 80)
    given += [(200, 0, [2**31] * 6), (201, 0, [2**30 + 7] * 6), (202, 1, [2**29, 3, 2, 1, 0, 0]), (210, 1, [0] * 6)]
    given += [(220, 0, [2**62] * 6), (221, 1, [-(2**62)] * 6), (222, 2, [2**61] + [0] * 5)]
    assert mined(spark, given) == plain(given)


def test_empty(spark):
    given = frame(spark, clustered_rows(9, 9))
    for df, asked in ((given.limit(0), anchors()), (given, F.col("vec_id") == 77)):
        found = hard_negatives(df, asked)
        assert found.collect() == [] and dict(found.dtypes)["rank"] == "int" and len(found.columns) == 6


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for scale in (10, 2**26, 2**31, 2**62):
        a, b = (rng.integers(-scale, scale, (7, 5)) for _ in range(2))
        wanted = [[max(-(2**63 - 1), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for q in b] for p in a]
        assert products(a, b).tolist() == wanted


def test_walks_stop_early_where_directions_cluster():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    vectors = np.floor(300 * (centres[rng.integers(0, 20, 6000)] + 0.05 * rng.normal(size=(6000, 16)))).astype(np.int64)
    labels, ids = rng.integers(0, 3, 6000), np.arange(6000)
    anchors = Anchors(np.arange(60), ids[:60], labels[:60], vectors[:60])
    kept = Positives(anchors, Rule())
    made = walk(kept, ids, labels, vectors)
    assert made < 0.5 * 60 * 6000
    scores = vectors[:60] @ vectors.T
    rows = kept.rows()
    for anchor in range(60):
        wanted = sorted((-scores[anchor, i], i) for i in ids if i != anchor and labels[i] == labels[anchor])[:5]
        own = rows[rows["anchor"] == anchor]
        assert list(zip(-own["score"], own["vec_id"], strict=True)) == wanted
    targets = rows.assign(target=rows.groupby("anchor").cumcount() + 1, anchor_id=rows["anchor"])
    negatives = Negatives(anchors, targets, Rule())
    assert walk(negatives, ids, labels, vectors) < 0.95 * 60 * 6000


def test_quantised(spark):
    rows = [
        (1, 3, [0.5, -0.001, 0.0]), (2, 3, None), (3, 3, [None, 1.0, 1.0]), (4, 3, [float("nan"), 1.0, 1.0]),
        (5, 3, [float("inf"), 1.0, 1.0]), (6, None, [1e30, -1e30, 1e-40]), (7, 1, []),
    ]
    given = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    found = {row.vec_id: row.vector for row in quantised(given).collect()}
    assert found == {1: [128, -1, 0], 6: [2**63 - 1024, -(2**63 - 1024), 0], 7: []}
