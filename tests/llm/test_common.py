import random

import numpy as np
import pandas as pd

from tunelake.llm import bag_minhash, common
from tunelake.llm.common import shingle_hashes, weighted_jaccard, word_hashes


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(1)
    words = ["a", "b", "ab", "ba", "é", "日本", "x" * 300, "\x1f", "aa", "aaa", "\xa0"]
    text = [rng.choice(words) for _ in range(500)]
    hashes = word_hashes("\n \t".join(text) + " ")
    by_word = {}
    for word, code in zip(text, hashes.tolist(), strict=True):
        by_word.setdefault(word, set()).add(code)
    assert all(len(codes) == 1 for codes in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)
    assert (word_hashes("Ab BA") == word_hashes("ab\x0bba")).all()
    assert [len(word_hashes(text)) for text in (None, "", " \n")] == [0, 0, 0]


def test_blocks_do_not_change_hashes(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(5000)) + " " + "z" * 4000 + " end"
    whole = word_hashes(text)
    monkeypatch.setattr(common, "_BLOCK_BYTES", 1000)
    assert (word_hashes(text) == whole).all()


def test_twofold_hashes_of_spans(monkeypatch):
    data = np.frombuffer(b"some words and some more words " * 40, np.uint8)
    cuts = np.concatenate([[0], np.flatnonzero(data == 32)])
    starts, ends = cuts[:-1], cuts[1:]
    whole = common.twofold_hashes(data, starts, ends)
    by = {}
    for a, b, *codes in zip(starts, ends, *whole, strict=True):
        by.setdefault(data[a:b].tobytes(), set()).add(tuple(codes))
    assert all(len(codes) == 1 for codes in by.values())
    assert len({code[0] for codes in by.values() for code in codes}) == len({code[1] for codes in by.values() for code in codes}) == len(by)
    monkeypatch.setattr(common, "_BLOCK_BYTES", 50)
    assert all((a == b).all() for a, b in zip(whole, common.twofold_hashes(data, starts, ends), strict=True))


def _spans(rng, count):
    pieces = [rng.choice([b"aa", b"bb", b"c%d" % rng.randint(0, 60), b"x" * rng.randint(60, 70)]) for _ in range(count)]
    ends = np.cumsum([len(piece) for piece in pieces])
    return pieces, np.frombuffer(b"".join(pieces), np.uint8), ends - [len(piece) for piece in pieces], ends


def test_span_places(monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED_SPANS", 40)
    rng, known, rows, calls = random.Random(4), common.SpanPlaces(), common.Rows(1, object), []
    for _ in range(30):
        pieces, data, starts, ends = _spans(rng, 50)

        def add(new, keep):
            assert len(set(new)) == len(new) and not (keep and max(map(len, new)) > 64)
            calls.append((len(new), keep))
            return rows.add(np.array([[piece] for piece in new], object), keep)

        places = known.of(data, starts, ends, add)
        assert rows.held[places, 0].tolist() == pieces
    assert known.size == rows.size <= 40 and {keep for _, keep in calls} == {True, False}


def test_the_tables_of_places_join():
    known, rng = common.SpanPlaces(), np.random.default_rng(2)
    keys = rng.integers(0, 2**63, (60_000, 2)).astype(np.uint64)
    keys[:, 0] = np.sort(keys[:, 0])
    for k in range(6):
        known._remember(keys[k::6, 0], keys[k::6, 1], np.arange(60_000)[k::6])
    found = np.full((2, 60_000), -1)
    for table in (known.large, known.small):
        table.find(keys[:, 0], keys[:, 1], found[0])
        table.find(keys[:, 0], keys[:, 1] + np.uint64(1), found[1])
    assert found[0].tolist() == list(range(60_000)) and (found[1] == -1).all() and len(known.large.columns[0])


def test_pieces_of_texts():
    texts = ["a bb", None, "", "  ccc\t\xa0d ", "e"]
    data, starts, ends, bounds = common.pieces_of(texts)
    pieces = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert [pieces[a:b] for a, b in zip(bounds, bounds[1:])] == [["a", "bb"], [], [], ["ccc", "\xa0d"], ["e"]]
    assert common.pieces_of([None])[1].tolist() == [] and common.pieces_of([])[3].tolist() == [0]


def test_a_worker_keeps_one_thing():
    first = common.worker_state("a", lambda: [1])
    assert common.worker_state("a", lambda: [2]) is first and common.worker_state("b", lambda: [3]) == [3]
    assert common.worker_state("a", lambda: [4]) == [4]


def test_distinct():
    assert common.distinct(np.array([3, 1, 3, 2, 1])).tolist() == [1, 2, 3] and common.distinct(np.empty(0)).tolist() == []


def test_rows_behind_the_kept_ones_are_written_over():
    rows = common.Rows(2)
    assert rows.add(np.ones((3, 2)), True) == 0 and rows.add(np.full((5000, 2), 2.0), False) == 3
    assert rows.add(np.full((2, 2), 3.0), True) == 3 and rows.held[:6, 0].tolist() == [1, 1, 1, 3, 3, 2]


def test_text_chunks():
    assert list(common.text_chunks(["abc", None, "d", "efgh", ""], 4)) == [["abc", None, "d"], ["efgh"], [""]]
    assert list(common.text_chunks([], 4)) == []


def test_weighted_jaccard():
    values = [np.array(v, np.uint64) for v in ([1, 1, 2], [1, 2, 2, 3], [])]
    assert weighted_jaccard(values[0], values[1]) == 2 / 5
    assert weighted_jaccard(values[0], values[2]) == 0
    assert len(shingle_hashes(word_hashes("a b c d e f"))) == 2
    assert shingle_hashes(word_hashes("a b"))[0] != shingle_hashes(word_hashes("a b c"))[0]


def test_work_that_keeps_nothing_lets_go_of_what_a_worker_holds():
    held = common.worker_state("large", lambda: bytearray(1 << 20))
    assert common.worker_state("large", lambda: None) is held
    list(bag_minhash._described(iter([pd.DataFrame({"doc_id": [1, 2], "text": ["one two", None]})])))
    assert common._held == ["", None]


def test_every_id_is_perhaps_among_the_ids_and_few_others_are(spark):
    ids = spark.range(0, 3000, 3).selectExpr("id AS doc_id").unionByName(spark.range(5).selectExpr("id * 3 AS doc_id"))
    rows = spark.range(6000).selectExpr("id AS doc_id", "id % 7 AS other")
    told = common.perhaps_among(rows, ids)
    assert told.columns == ["doc_id", "other", "perhaps"]
    found = {r.doc_id: r.perhaps for r in told.collect()}
    assert len(found) == 6000 and all(found[i] for i in range(0, 3000, 3)) and sum(found.values()) < 1010
    assert told.where("doc_id = 5").select("other").first().other == 5
    assert common.perhaps_among(rows, ids.limit(0)).where("perhaps").count() == 0
