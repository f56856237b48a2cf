import random

import numpy as np
import pytest

from tunelake.llm import decontaminate
from tunelake.llm.common import mixed, sequence_hashes, shingle_hashes, weighted_jaccard, word_hashes

DOCS = "doc_id long, text string, item_id string, similarity string"
ITEMS = "item_id long, text string, doc_id string"


def test_the_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**16, (40, 4)).astype(np.uint16)
    asked = rng.integers(0, 2**16, (500, 4)).astype(np.uint16)
    asked[:40] = prints ^ np.uint16(0x0421)
    for radius in (0, 3, 12, 24):
        places, items = decontaminate.MultiIndex(prints, radius).within(asked)
        every = decontaminate._BIT_COUNTS[asked[:, None] ^ prints[None]].sum(axis=2) <= radius
        assert set(zip(places.tolist(), items.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every))))


def _brute_force(rows, items):
    found = {}
    for doc_id, text in rows:
        words = word_hashes(text)
        for item_id, wanted in items:
            size = len(word_hashes(wanted))
            for start in range(len(words) - size + 1 if size else 0):
                part = words[start:start + size]
                value = weighted_jaccard(shingle_hashes(part), shingle_hashes(word_hashes(wanted)))
                if value >= 0.8:
                    key = (doc_id, item_id)
                    found[key] = max(found.get(key, 0), round(value, 6))
    return found


def _case(seed=4):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 5, 14, 30, 59])))) for i in range(25)]
    items += [(100, "again " * 20), (101, None), (102, ""), (103, " ".join(words[:40]))]
    rows = []
    for doc in range(80):
        text = [rng.choice(words) for _ in range(rng.choice([3, 40, 200]))]
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            if part and rng.random() < 0.5:
                part[rng.choice([0, -1, len(part) // 2])] = "edited"
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        rows.append((doc, " ".join(text).title() if doc % 3 == 0 else "\n".join(text)))
    return [*rows, (200, None), (201, ""), (202, "again " * 3000)], items


def test_findings_equal_those_of_all_windows(spark):
    rows, items = _case()
    got = decontaminate.contaminated(
        spark.createDataFrame([(*r, "x", None) for r in rows], DOCS).repartition(3),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
    ).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == _brute_force(rows, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) > 20
    texts, wanted = dict(rows), dict(items)
    for r in got:
        window = word_hashes(texts[r.doc_id])[r.first_word:r.first_word + r.n_words]
        assert weighted_jaccard(shingle_hashes(window), shingle_hashes(word_hashes(wanted[r.item_id]))) >= 0.8


def test_more_items_than_fit_at_once_are_searched_in_passes(spark, monkeypatch):
    rows, items = _case(5)
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    got = decontaminate.contaminated(
        spark.createDataFrame([(*r, "x", None) for r in rows[:40]], DOCS),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
    ).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == _brute_force(rows[:40], items)


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f", None, None), (1, None, None, None)], DOCS)
    items = spark.createDataFrame([(None, "a b c d e f", None), (3, "zz", None)], ITEMS)
    assert [tuple(r) for r in decontaminate.contaminated(docs, items).collect()] == [(None, None, 1.0, 0, 6)]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_short_items_are_whole_shingles():
    words = word_hashes("one two three")
    pair = mixed(sequence_hashes(words, 2) + np.uint64(2))
    assert pair[1] == shingle_hashes(word_hashes("two three"))[0]
    assert decontaminate.Benchmark([(1, "Two  three")]).matches("one two three") == [(1, pytest.approx(1.0), 1, 2)]


def _brute_force_with_cut_items(rows, items):
    """As above, and a document with fewer words than the item is compared as a whole."""
    found = _brute_force(rows, items)
    for doc_id, text in rows:
        words = word_hashes(text)
        for item_id, wanted in items:
            if 0 < len(words) < len(word_hashes(wanted)):
                value = weighted_jaccard(shingle_hashes(words), shingle_hashes(word_hashes(wanted)))
                if value >= 0.8:
                    found[doc_id, item_id] = max(found.get((doc_id, item_id), 0), round(value, 6))
    return found


def test_a_document_that_is_a_cut_item_is_found(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(size))) for i, size in enumerate((3, 4, 5, 9, 16, 30, 50, 59))]
    items += [(50, "again " * 30), (51, " ".join(items[6][1].split()[:-1])), (52, None)]
    rows = []
    for _, text in items[:-1]:
        part = text.split()
        for cut in range(len(part) // 3 + 1):
            left = rng.randint(0, cut)
            rows.append((len(rows), " ".join(part[left:len(part) - cut + left])))
            edited = part[:len(part) - cut]
            edited[rng.randrange(len(edited))] = "edited"
            rows.append((len(rows), " ".join(edited)))
    got = decontaminate.contaminated(
        spark.createDataFrame([(*r, "x", None) for r in rows], DOCS).repartition(3),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
    ).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == _brute_force_with_cut_items(rows, items)
    assert len(got) > len(_brute_force(rows, items)) + 20
    texts = dict(rows)
    assert all(r.first_word + r.n_words <= len(word_hashes(texts[r.doc_id])) for r in got)
    cut = " ".join(items[6][1].split()[:-2])
    assert (6, pytest.approx(44 / 46, abs=1e-6), 0, 48) in decontaminate.Benchmark(items).matches(cut)
