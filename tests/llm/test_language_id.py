import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import common, language_id, queries
from tunelake.llm.language_id import Identifier, Network, Training, byte_runs

SF = "/root/testdata/sf0.001"
SMALL = Training(hidden=5, steps=60, batch=32)


def test_gradients_equal_differences():
    network = Network(["a", "b", "c"], Training(hidden=4, seed=3))
    for direction in (network.ahead, network.back):
        direction.x, direction.u = direction.x.astype(np.float64), direction.u.astype(np.float64)
    network.out, network.bias = network.out.astype(np.float64), network.bias.astype(np.float64)
    runs, truth = [b"hello", b"w\xc3\xb6rt", b"a1", b"x"], np.array([0, 1, 2, 1])
    _, slopes = network.gradients(runs, truth)
    rng = np.random.default_rng(0)
    for weight, slope in zip(network.weights, slopes, strict=True):
        places = np.argwhere(np.abs(slope) > 1e-4)
        for place in places[rng.permutation(len(places))[:4]]:
            place, value = tuple(place), weight[tuple(place)]
            weight[place] = value + 1e-3
            more, _ = network.gradients(runs, truth)
            weight[place] = value - 1e-3
            less, _ = network.gradients(runs, truth)
            weight[place] = value
            assert (more - less) / 2e-3 == pytest.approx(slope[place], rel=0.05, abs=2e-4)


def test_padding_does_not_change_a_run():
    network = Network(["a", "b"], SMALL)
    runs = [byte_runs(run)[0] for run in (b"some", b"considerably-longer", b"42", b"x")]
    together = network.letter_sums(runs)
    for run, sums in zip(runs, together, strict=True):
        assert network.letter_sums([run])[0] == pytest.approx(sums, abs=1e-5)
    assert together[2].tolist() == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("piece", ["é" * 1000 + "x", "日本" * 300, "a" * 33, "😀" * 9 + "bc", "x" * 32])
def test_every_byte_of_a_long_run_is_read_once(piece):
    windows = byte_runs(piece.encode())
    assert b"".join(data[first:behind] for data, first, behind in windows) == piece.encode()
    assert all(data.decode() and behind - first <= 36 for data, first, behind in windows)  # cut between characters
    assert Identifier(Network(["a", "b"], SMALL))._read([piece.encode()])[0, -1] == len(piece.encode())


def test_forgetting_does_not_change_results(monkeypatch):
    network = Network(["a", "b"], SMALL)
    texts = [f"tok{i} some words tok{i + 1} {'long' * i}" for i in range(30)]
    whole = Identifier(network).predict(texts)
    monkeypatch.setattr(common, "REMEMBERED_SPANS", 8)
    monkeypatch.setattr(common, "CHUNK_CHARS", 60)
    parts = Identifier(network)
    pieces = [parts.predict(texts[i:i + 4]) for i in range(0, 30, 4)]
    assert 0 < parts.known.size < 9
    assert [n for p in pieces for n in p[0]] == whole[0]
    assert [s for p in pieces for s in p[1]] == pytest.approx(whole[1], abs=1e-5)


def test_unspaced_texts_are_not_remembered():
    own = Identifier(Network(["a", "b"], SMALL))
    own.predict(["".join(chr(97 + (i * k) % 26) for i in range(20_000)) for k in range(1, 20)])
    assert own.known.size == own.sums.size == 0 and len(own.sums.held) <= 1024


def test_pooled_probabilities_are_means_over_letters():
    network = Network(["a", "b", "c"], SMALL)
    text = "Plain wörds, 42 and 日本語 " + "unspaced" * 9
    plain = []
    for piece in text.split():
        for data, first, behind in byte_runs(piece.encode()):
            given, _ = network.probabilities(*network.padded([data]))
            plain += [
                given[t, 0] for t in range(first, behind) if data[t] >= 128 or chr(data[t]).isalpha()
            ]
    mean = np.mean(np.array(plain, np.float64), axis=0)
    names, scores = Identifier(network).predict([text])
    assert names == [network.languages[int(mean.argmax())]] and scores[0] == pytest.approx(mean.max(), abs=1e-5)


def test_spans_are_the_labels_of_the_positions():
    network = Network(["a", "b"], SMALL)
    text = "some wörds 42 in " + "日本語x" * 20 + " ."
    labels = []
    for piece in text.split(" "):
        for data, first, behind in byte_runs(piece.encode()):
            best = network.probabilities(*network.padded([data]))[0][:, 0].argmax(axis=1)
            labels += [
                int(best[t]) if data[t] >= 128 or chr(data[t]).isalpha() else -1
                for t in range(first, behind) if data[t] & 0xC0 != 0x80
            ]
        labels.append(-1)
    own = Identifier(network)
    assert own.labels(text).tolist() == labels[:-1]
    spans = own.spans(text)
    for (lang, first, behind), following in zip(spans, [*spans[1:], None], strict=True):
        assert {network.languages[k] for k in labels[first:behind] if k >= 0} == {lang}
        assert following is None or (following[0] != lang and behind <= following[1])
    assert sum(k >= 0 for _, f, b in spans for k in labels[f:b]) == sum(k >= 0 for k in labels)
    assert own.spans(None) == own.spans("42 !") == []


def _languages():
    rng = np.random.default_rng(4)
    make = {"xx": ["ab", "ba", "aab", "bab"], "yy": ["cd", "dc", "ccd", "dcd"]}
    return [
        (i, " ".join(rng.choice(make[lang], 30)), lang, "clash") for i in range(60) for lang in [("xx", "yy")[i % 2]]
    ]


def test_held_out_accuracy_and_defined_results(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = _languages()
    docs = spark.createDataFrame(rows, schema)
    network = language_id.learnt_network(docs, language_id.learning_rule(), SMALL)
    odd = [(100, None, "xx", None), (101, "", None, None), (102, "12 34 ,,", "yy", None), (None, "abab", "yy", None),
           (103, "dcd", None, None), (104, "ab " * 60000 + "ba", "zz", None)]
    found = language_id.identify(docs.unionByName(spark.createDataFrame(odd, schema)), network)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert all(got[i] == ("und", 0.0) for i in (100, 101, 102))
    assert got[103][0] == "yy" and got[104][0] == got[None][0] == "xx"
    assert all(got[i][0] == lang and 0.5 < got[i][1] <= 1 for i, _, lang, _ in rows)


def test_held_out_rows_are_not_learnt_from(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(i, "abc def", "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "seen") for i in range(40)]
    network = language_id.learnt_network(spark.createDataFrame(rows, schema), language_id.learning_rule(), SMALL)
    assert network.languages == ["seen"]


def test_the_sample_is_bounded_with_hot_and_long_rows(spark):
    rows = [(7, "aa " * 50_000, "xx")] * 300 + [(i, "bb cc", "yy") for i in range(500)] + [(i, "dd", "zz") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    sample = language_id.learnt_sample(docs, F.lit(True), Training(docs=20, windows=8, languages=2))
    assert [lang for lang, _ in sample].count("xx") == 1 and [lang for lang, _ in sample].count("yy") == 20
    assert len(sample) == 21 and max(len(windows) for _, windows in sample) == 8


def test_labelled_spans(spark):
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([row[:3] for row in _languages()], schema)
    network = language_id.learnt_network(docs, training=SMALL)
    mixed = spark.createDataFrame([(1, "abba baba aab dcdc cdcd dcd", "q"), (2, None, "q")], "doc_id long, text string, spans string")
    found = {row.doc_id: row.spans for row in language_id.labelled_spans(mixed, network).collect()}
    assert [span.lang for span in found[1]] == ["xx", "yy"] and found[2] == []
    assert (found[1][0].first, found[1][-1].behind) == (0, 27) and found[1][0].behind <= 14
    assert language_id.labelled_spans(mixed, None).first().spans == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    network = language_id.learnt_network(docs)
    assert network is None
    assert language_id.identify(docs, network).first().lang_pred == "und"
    assert language_id.identify(docs.limit(0), network).count() == 0


def test_given_documents(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").collect()}
    got = queries.op10_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > 0.93
