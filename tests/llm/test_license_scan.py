import random
import re

import pytest

from tunelake.llm import license_scan
from tunelake.llm.license_scan import NOTICES, PHRASES, Template, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(small)


def plain_spans(text, templates):
    """Diagonal by diagonal, as the module describes it."""
    own, found = plain_words(text), []
    for template in templates:
        wanted = plain_words(template.text)
        size = len(wanted)
        k = min(3, size)
        places = {}
        for i in range(len(own) - k + 1):
            for p in range(size - k + 1):
                if own[i:i + k] == wanted[p:p + k]:
                    places.setdefault(i - p, set()).add(p)
        chains, play = [], 0 if template.exact else size // 5
        for diagonal in sorted(places):
            if chains and diagonal - chains[-1][-1] <= play:
                chains[-1].append(diagonal)
            else:
                chains.append([diagonal])
        for chain in chains:
            covered = {p + n for d in chain for p in places[d] for n in range(k)}
            first = min(d + min(places[d]) for d in chain)
            behind = max(d + max(places[d]) for d in chain) + k
            if len(covered) >= size * (1 if template.exact else 0.8) and behind - first <= 1.25 * size:
                found.append((first, behind, template.label, template.exact, len(covered) / size))
    return sorted(found)


def as_result(text, templates=(*PHRASES, *NOTICES)):
    found = plain_spans(text, templates)
    base = [span for span in found if span[3]]
    return (
        len(plain_words(text)), len(base), min((s[0] for s in base), default=None), max((s[0] for s in base), default=None),
        ",".join(sorted({s[2] for s in base})), ",".join(sorted({s[2] for s in found})),
        max((s[4] for s in found), default=0.0),
    )


def results(found):
    return {
        row.doc_id: (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, row.score)
        for row in found.collect()
    }


def noisy(seed, count):
    """Notices cut, changed and repeated between other words."""
    rng = random.Random(seed)
    for _ in range(count):
        out = []
        for _ in range(rng.randint(0, 4)):
            own = rng.choice([*PHRASES, *NOTICES]).text.split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                at = rng.randrange(len(own)) if own else 0
                own[at:at + 1] = rng.choice([[], ["more"], [*own[at:at + 1], "very", "much"], [*own[at:at + 1], "OF,"]])
            out += own + rng.choice([[], ["CC-BY"], ["of", "the", "work"], ["all", "rights"], ["general", "PUBLIC"]])
        yield rng.choice([" ", "  ", "\n", ", "]).join(out)


def test_equals_brute_force(spark):
    rows = [(i, text) for i, text in enumerate(noisy(5, 300))]
    assert results(scan(spark.createDataFrame(rows, "doc_id long, text string"))) == {i: as_result(t) for i, t in rows}


@pytest.mark.parametrize("text, labels, places", [
    ("CC BY", "cc-by", (0, 0)), ("cc-by cc by", "cc-by", (0, 2)), ("ccby c c by", "", None),
    ("cc byé", "", None), ("\u212aall all rights reserved", "reserved", (1, 1)),
    ("the GNU general, public. License!", "gpl", (2, 2)), ("public license general", "", None),
    ("Released under the old MIT License", "", None), ("as Released under the MIT licence here", "mit", None),
])
def test_phrases(spark, text, labels, places):
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == labels and (row.first_word, row.last_word) == (places or (None, None))


def test_a_changed_notice_is_one_span(spark):
    own = NOTICES[1].text.split()
    text = " ".join(["before", *own[:9], "very", "much", *own[9:20], *own[21:]])
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == "apache-2.0" and len(row.notices) == 1 and 0.8 <= row.score < 1
    assert (row.notices[0].first, row.notices[0].behind) == (1, 1 + len(own) + 1)


def test_rules(spark):
    notice = "All rights reserved. "
    rows = [
        (1, None, "a"), (2, "", "b"), (None, notice, "c"), (4, notice, "d"), (4, notice, "d"), (4, "cc by", "e"),
        (5, notice * 5000 + "x " * 50_000, "f"), (None, "cc by", "g"),
    ]
    found = scan(spark.createDataFrame(rows, "doc_id long, text string, score string"))
    assert found.columns.count("score") == 1
    seen = sorted((row.doc_id or 0, row.n_words, row.n_base, row.first_word, row.last_word, row.labels) for row in found.collect())
    assert seen == [
        (0, 2, 1, 0, 0, "cc-by"), (0, 3, 1, 0, 0, "reserved"), (1, 0, 0, None, None, ""), (2, 0, 0, None, None, ""),
        (4, 2, 1, 0, 0, "cc-by"), (4, 3, 1, 0, 0, "reserved"), (4, 3, 1, 0, 0, "reserved"),
        (5, 65_000, 5000, 0, 14_997, "reserved"),
    ]
    given = spark.createDataFrame(rows, "doc_id long, text string, score string")
    assert scan(given.where("doc_id > 99")).collect() == []
    assert {(row.labels, row.score) for row in scan(given, ()).collect()} == {("", 0.0)}


def test_exact_templates_have_no_play(spark):
    template = Template("own", "one two three four five six", exact=True)
    rows = [(1, "one two three four five six"), (2, "one two three x four five six"), (3, "one two three four five six " * 2)]
    found = results(scan(spark.createDataFrame(rows, "doc_id long, text string"), [template]))
    assert {key: row[1:4] for key, row in found.items()} == {1: (1, 0, 0), 2: (0, None, None), 3: (2, 0, 6)}


def test_no_python_and_a_broadcast_of_templates_alone(spark, monkeypatch):
    given = spark.createDataFrame([(1, "cc by")], "doc_id long, text string")
    plan = scan(given)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    monkeypatch.setattr(license_scan, "BROADCAST_WORDS", 0)
    assert results(scan(given)) == {1: (2, 1, 0, 0, "cc-by", "cc-by", 1.0)}
