import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelake.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _many():
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        source = None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 7}"
        rows.append((i, "w " * int(rng.lognormvariate(4, 1)), source, "clash"))
    return rows


def test_targets_stop_at_the_cap_and_share_the_excess():
    assert mixing.target_sizes([10, 10, 80], [5, 2, 1], 100, 3) == pytest.approx([30, 30, 40])
    assert mixing.target_sizes([0, 5], [5, 2], 5, 3) == pytest.approx([0, 5])
    assert mixing.target_sizes([], [], 0, 3) == []


def test_words_taken_meet_the_targets(spark):
    rows = _many()
    mixed = mixing.mix(_docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in mixed) == list(range(6000))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _, _ in rows}
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        assert own[0].source_size == sum(sizes[r.doc_id] for r in own)
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.005)
        assert all(r.taken == r.copies * r.size <= 3 * r.size and abs(r.copies - r.rate) < 1 for r in own)
    order = sorted({r.source for r in mixed}, key=lambda s: (s is None, s or ""))
    totals = {r.source: r.source_size for r in mixed}
    expected = mixing.target_sizes(
        [totals[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))], sum(totals.values()), 3
    )
    assert [next(r.target for r in mixed if r.source == s) for s in order] == pytest.approx(expected)


def test_the_mix_does_not_depend_on_the_partitioning(spark):
    docs = _docs(spark, _many()[:500])
    first = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(3)).collect()}
    assert first == {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7, "text")).collect()}


def test_prior_rates_tilt_the_mix_and_the_newton_steps_meet_the_constraint(spark):
    rows = [(i, "w " * (10 + i % 90), "ab"[i % 2], None) for i in range(2000)]
    mixed = mixing.mix(_docs(spark, rows), offset=F.when(F.col("doc_id") % 4 < 2, 0.0).otherwise(1.5)).collect()
    for source in "ab":
        own = [r for r in mixed if r.source == source]
        assert math.fsum(r.rate * r.size for r in own) == pytest.approx(own[0].target, rel=1e-6)
        low, high = ({r.rate for r in own if (r.doc_id % 4 >= 2) == tilted} for tilted in (False, True))
        assert len(low) == len(high) == 1
        assert high.pop() == pytest.approx(min(3.0, low.pop() * math.exp(1.5)))


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(1, None, None, None), (None, "a b", "x", None), (2, "", "x", None), (3, "c d", "x", None),
            (3, "c d", "x", None), (4, "\x1f\x0b\xa0  e", "y", None)]
    mixed = mixing.mix(_docs(spark, rows)).collect()
    assert len(mixed) == 6
    assert {r.doc_id: r.size for r in mixed} == {1: 0, None: 2, 2: 0, 3: 2, 4: 3}
    assert len({r.copies for r in mixed if r.doc_id == 3}) == 1
    assert mixing.mix(_docs(spark, [])).count() == 0


def test_rows_are_repeated_with_all_columns(spark):
    docs = _docs(spark, _many()[:300] + [(None, "n", None, "z")])
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] = r.copies
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    counted = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counted == {k: v for k, v in copies.items() if v}


def _hot_row(n=45_000, hot=2300):
    """Different documents for ten groups and more, and one row repeated so often that it holds a third of the words."""
    rows = [(i, "w " * 10, "a", None) for i in range(n)] + [(i, "w " * 10, "b", None) for i in range(n, n + 500)]
    return rows + [(-1, "hot " * 100, "a", str(i % 3) if i % 2 else None) for i in range(hot)]


def test_a_hot_repeated_row_does_not_move_the_mix_from_its_target(spark):
    docs = _docs(spark, _hot_row())
    # Half of all words are due from b, so that a is taken at a rate between whole numbers.
    mixed = mixing.mix(docs, weights=(1.0, 1.0), max_rate=70.0).where("source = 'a'")
    row = mixed.agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("rate").alias("rate")).first()
    assert 0.3 < row.rate < 0.7 and row.taken == pytest.approx(row.target, rel=0.001)
    copies = {r.copies: r["count"] for r in mixed.where("doc_id = -1").groupBy("copies").count().collect()}
    assert set(copies) == {0, 1} and sum(copies.values()) == 2300 and copies[1] == pytest.approx(2300 * row.rate, abs=10)


def test_repeated_rows_get_neighbouring_copies_with_all_columns(spark):
    rows = _hot_row(600, 90) + [(None, "n m", "a", None)] * 7 + [(-2, "x " * 9, "b", "z")] * 5
    docs = _docs(spark, rows)
    wanted = mixing.mix(docs, weights=(3.0, 2.0)).groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0")
    taken = [mixing.mixed_rows(docs.repartition(k), weights=(3.0, 2.0)).collect() for k in (2, 5)]
    counts = [Counter(tuple(r) for r in one) for one in taken]
    assert counts[0] == counts[1] and set(counts[0]) <= set(rows)
    by_id = Counter(r.doc_id for r in taken[0])
    assert dict(by_id) == {r.doc_id: r.n for r in wanted.collect()}
    given = Counter(rows)
    rates = {r.source: r.rate for r in mixing.mix(docs, weights=(3.0, 2.0)).collect()}
    for row, n in given.items():
        assert n * math.floor(rates[row[2]]) <= counts[0][row] <= n * math.ceil(rates[row[2]])
    assert any(counts[0][row] % n for row, n in given.items() if n > 1)
