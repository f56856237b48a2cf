import hashlib
import random
from fractions import Fraction

import numpy as np
import pandas as pd

from tunelake.llm import periodic_runs
from tunelake.llm.periodic_runs import batch_runs, best_run, kept_words, run_digests, runs_and_text
from tunelake.llm.queries import repeated_order

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_runs(own):
    """Every stretch of every period, of equal stretches the smallest period."""
    found = {}
    for period in range(1, len(own) // 3 + 1):
        equal = [own[i] == own[i + period] for i in range(len(own) - period)] + [False]
        begin = None
        for i, same in enumerate(equal):
            if same and begin is None:
                begin = i
            elif not same and begin is not None:
                if i - begin + period >= max(24, 3 * period):
                    found.setdefault((begin, i - begin + period), period)
                begin = None
    return sorted((start, length, period) for (start, length), period in found.items())


def texts(seed, count):
    """Texts of repeated units over few and many words, with units inside units."""
    rng = random.Random(seed)
    for _ in range(count):
        own = []
        for _ in range(rng.randint(0, 6)):
            unit = [b"%d" % rng.randint(0, rng.choice([0, 1, 2, 40])) for _ in range(rng.choice([1, 2, 3, 5, 8, 16, 17, 40]))]
            if rng.random() < 0.3:
                unit = unit * rng.randint(2, 30) + [b"x"]
            own += (unit * rng.randint(1, 20))[:rng.randint(1, 150)]
        yield own


def test_runs_equal_brute_force():
    for seed in range(60):
        given = list(texts(seed, 6))
        for own, runs in zip(given, batch_runs(given), strict=True):
            assert [tuple(run) for run in runs.tolist()] == plain_runs(own)


def test_kept_words_and_best_run_equal_brute_force():
    for own in texts(7, 200):
        runs = batch_runs([own])[0]
        kept = kept_words(len(own), runs)
        listed = runs.tolist()
        assert kept.tolist() == [not any(s + q <= i < s + n for s, n, q in listed) for i in range(len(own))]
        best = min(listed, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
        assert best_run(runs) == (tuple(best) if best else None)


def test_a_factor_over_the_end_of_a_text_does_not_count():
    assert [len(runs) for runs in batch_runs([[b"a"] * 20, [b"a"] * 20, [b"a"] * 24])] == [0, 0, 1]


def test_chunks_do_not_change_results(monkeypatch):
    given = list(texts(3, 40))
    rows = pd.DataFrame({"key": None, "text": [b" ".join(own).decode() for own in given]})
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 50)
    chunks = list(periodic_runs._chunks(rows, None))
    assert len(chunks) > 5 and [own for chunk in chunks for own in chunk] == given
    parts = [runs.tolist() for chunk in chunks for runs in batch_runs(chunk)]
    assert parts == [runs.tolist() for runs in batch_runs(given)]


def test_rules(spark):
    echo = "one two three " * 10
    rows = [
        (1, None, "a"), (2, "", "b"), (None, echo, "c"), (4, echo, "d"), (4, echo, None), (5, " \t\n ", "e"),
        (6, "w\xa0x " * 30 + " ", "f"), (7, "z " * 30_000, "g"), (8, "one two", "h"),
    ]
    given = spark.createDataFrame(rows, "doc_id long, text string, period string")
    found = runs_and_text(given)
    assert found.columns == ["doc_id", "text", "period", "n_words", "runs", "collapsed"]
    by = {(row.doc_id, row.period): row for row in found.collect()}
    assert len(by) == len(rows)
    for key in ((1, "a"), (2, "b"), (5, "e")):
        assert (by[key].n_words, by[key].runs, by[key].collapsed) == (0, [], "")
    for key in ((None, "c"), (4, "d"), (4, None)):
        assert by[key].collapsed == "one two three" and by[key].runs == [(0, 30, 3)]
    assert by[6, "f"].runs == [(0, 30, 1)] and by[6, "f"].collapsed == "w\xa0x  "
    assert by[7, "g"].runs == [(0, 30_000, 1)] and by[8, "h"].collapsed == "one two"
    digests = {row.doc_id: row for row in run_digests(given.where("doc_id < 4")).collect()}
    assert "text" in digests[1].asDict() and digests[1].runs_sha256 == digests[1].collapsed_sha256 == EMPTY
    assert digests[2].start is None and digests[2].period is None and digests[2].exponent_milli is None
    assert run_digests(given.where("doc_id > 99")).collect() == []


def test_words_read_in_another_order(spark):
    given = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    found = runs_and_text(given, lambda key, count: np.zeros(30, np.int64) if key == "2" else None, "doc_id")
    assert [(row.n_words, row.collapsed) for row in found.orderBy("doc_id").collect()] == [(4, "a b c d"), (30, "a")]


def test_rule_of_the_query():
    import zlib

    for doc_id in range(300):
        code, order = zlib.crc32(str(doc_id).encode()), repeated_order(str(doc_id), 100)
        if code % 10:
            assert order is None
            continue
        g = code // 10
        a = g % 100
        p = 1 + (100 - a) // (3 + g % 8)
        assert order.tolist() == [i if i < a else a + (i - a) % p for i in range(100)]
    assert repeated_order(None, 5) is None
