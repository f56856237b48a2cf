import random

import pandas as pd
import pytest

from tunelake.llm import line_dedup
from tunelake.llm.line_dedup import _distance, line_keys, within

SCHEMA = "doc_id long, text string, line string, root string"


def _edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at, what = rng.randrange(len(text) + 1), rng.random()
        if what < 0.4 and text:
            text[min(at, len(text) - 1)] = rng.choice("abé ")
        elif what < 0.7:
            text.insert(at, rng.choice("abé "))
        elif text:
            del text[min(at, len(text) - 1)]
    return "".join(text)


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_banded_distance_equals_the_table(edits):
    rng = random.Random(edits)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))
        b = _edited(rng, a, rng.randint(0, edits + 2))
        assert within(a, b, edits) == (_distance(a, b) <= edits) == within(b, a, edits)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_the_distance_share_a_key(edits):
    rng = random.Random(edits + 10)
    for _ in range(3000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(12, 40)))
        b = _edited(rng, a, rng.randint(0, edits))
        if len(b) >= line_dedup.SHORT and _distance(a, b) <= edits:
            short, long = sorted((a, b), key=len)
            entered = {k for k, role in line_keys(short, edits).items() if role & 1}
            assert entered & {k for k, role in line_keys(long, edits).items() if role & 2}


def test_hot_keys_and_batches_do_not_lose_pairs(monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINES", 5)
    rng = random.Random(4)
    rows = sorted(
        (key, line, rng.choice([1, 2, 3])) for key, size in enumerate([1, 2, 3, 30, 1, 4, 5, 6, 2]) for line in
        [rng.randrange(40) for _ in range(size)]
    )
    whole = pd.DataFrame(rows, columns=["key", "line_id", "role"])
    for size in (1, 2, 7, 100):
        pairs, hot = set(), {}
        for out in line_dedup._paired(whole.iloc[at:at + size] for at in range(0, len(whole), size)):
            for row in out.itertuples(index=False):
                if pd.isna(row.b):
                    hot.setdefault(row.hot_key, set()).add(row.a)
                else:
                    pairs.add((row.a, row.b))
        for key, own in whole.groupby("key"):
            indexed, asked = (set(own[own.role & bit > 0].line_id) for bit in (1, 2))
            if key in hot:
                assert hot[key] == set(own.line_id)
            else:
                assert {(min(i, j), max(i, j)) for i in indexed for j in asked if i != j} <= pairs


def _brute_force(rows):
    occurrences = [
        (doc, no, line) for doc, text in rows for no, line in enumerate((text or "").split("\n")) if line.strip(" \t\r\f\v")
    ]
    distinct = sorted({line for *_, line in occurrences})
    root = {line: line for line in distinct}

    def find(line):
        while root[line] != line:
            line = root[line]
        return line

    links = dict.fromkeys(distinct, 0)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if min(len(a), len(b)) >= line_dedup.SHORT and abs(len(a) - len(b)) <= 2 and _distance(a, b) <= 2:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    order = lambda o: (o[0] is not None, o[0] or 0, o[1])
    heads = {}
    for one in sorted(occurrences, key=order):
        heads.setdefault(find(one[2]), one[:2])
    return sorted(((d, n, *heads[find(t)], links[t], heads[find(t)] == (d, n)) for d, n, t in occurrences), key=str)


def test_classes_and_links_equal_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 8)
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 6)
    bases = ["".join(rng.choice("abcdefg ") for _ in range(rng.choice([3, 11, 12, 13, 30, 60]))) for _ in range(12)]
    rows = [(None, "no id line here\n" + bases[5]), (3, None), (4, ""), (5, "\n \n\t\r\n"), (6, "short"), (7, "shorts\nshort")]
    for doc in range(10, 60):
        rows.append((doc, "\n".join(_edited(rng, rng.choice(bases), rng.randint(0, 3)) for _ in range(rng.randint(1, 4)))))
    rows.append((60, rows[-1][1]))
    rows.append((61, "q" * 3000 + "\n" + "q" * 3001))
    got = line_dedup.near_lines(spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_force(rows)


def test_empty_table(spark):
    assert line_dedup.near_lines(spark.createDataFrame([], SCHEMA)).count() == 0
