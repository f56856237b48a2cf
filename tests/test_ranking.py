import random

import pytest
from pyspark.sql import functions as F

from tunelake.operators import ranking


@pytest.fixture(params=[1, 7, 1 << 20])
def block(request, monkeypatch):
    """Ranks must not depend on where the blocks are cut."""
    monkeypatch.setattr(ranking, "BLOCK_VALUES", request.param)


@pytest.fixture(scope="module")
def scores(spark):
    """A third of the rows share one value."""
    draw = random.Random(3)
    rows = [(i, draw.choice("abc"), 40 if i % 3 == 0 else draw.randrange(0, 90)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id int, g string, v bigint")


def test_overall_and_group_ranks(block, scores):
    rows, df = scores
    ranked = ranking.with_ranks(df, df.select("g", "v"), "v", "place", "g", "group_place").collect()
    assert len(ranked) == len(rows)
    for r in ranked:
        assert r.place == 1 + sum(v > r.v for _, _, v in rows)
        assert r.group_place == 1 + sum(v > r.v for _, g, v in rows if g == r.g)


def test_percent_ranks(block, scores):
    rows, df = scores
    for r in ranking.with_percent_rank(df, df, "v", "p").collect():
        assert r.p == pytest.approx(sum(v < r.v for _, _, v in rows) / (len(rows) - 1))


def test_percent_rank_of_a_single_row_is_zero(spark):
    one = spark.createDataFrame([(1, 5)], "id int, v bigint")
    assert ranking.with_percent_rank(one, one, "v", "p").first().p == 0.0


def test_top_rows_per_group(scores):
    rows, df = scores
    top = ranking.top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 4, "place").collect()
    for group in "abc":
        expected = sorted((r for r in rows if r[1] == group), key=lambda r: (-r[2], r[0]))[:4]
        got = sorted((r for r in top if r.g == group), key=lambda r: r.place)
        assert [(r.id, r.g, r.v) for r in got] == expected and [r.place for r in got] == [1, 2, 3, 4]
