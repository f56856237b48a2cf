import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from tests.llm.test_bag_minhash import _brute_force as classes_of
from tests.llm.test_bag_minhash import shuffled_bytes, unrelated
from tests.llm.test_decontaminate import _brute_force as findings_of
from tests.llm.test_token_files import _expected as ids_of
from tunelake.llm import common, mixing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage makes of the given documents and a few odd ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 70")
    odd = [(None, "une phrase sans id pour voir", "fr", "src1", 1), (900_001, None, "en", None, 0),
           (900_002, "", None, "src1", 0), (900_003, "12 34 !", "en", "src1", 7),
           (900_004, "the and of " * 30, None, None, None), (900_004, "the and of " * 30, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("given", F.lit("clash"))
    kept = [("documents", docs.cache())]
    for name, stage in corpus_pipeline.STAGES:
        kept.append((name, stage(spark, kept[-1][1], SF).cache()))
    return dict(kept)


def _rows(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_all_stages_but_the_last_return_the_columns_of_documents(stages):
    columns = stages["documents"].columns
    assert all(stages[name].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])


def test_language_drops_texts_without_a_language_only(stages):
    before, after = _rows(stages["documents"]), _rows(stages["language"])
    assert set(before) - set(after) == {(900_001, None), (900_002, ""), (900_003, "12 34 !")}
    assert len(before) - len(after) == 3


def test_one_document_of_each_group_stays(stages):
    given = [r for r in _rows(stages["language"]) if r[0] is not None]
    classes = classes_of(dict(given).items())
    stay = {i for i, root in classes.items() if i == root}
    kept = _rows(stages["near_copies"])
    assert {i for i, _ in kept if i is not None} == stay and len(kept) == len(stay) + 1


def test_documents_with_benchmark_items_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = _rows(stages["near_copies"])
    held = {i for i, _ in findings_of([r for r in before if r[0] is not None], items)}
    assert sorted(_rows(stages["benchmark"]), key=str) == sorted((r for r in before if r[0] not in held), key=str)


def test_documents_stand_as_often_as_the_mix_takes_them(stages):
    wanted = {}
    for row in mixing.mix(stages["benchmark"]).collect():
        wanted[row.doc_id] = row.copies
    counted = {}
    for doc_id, _ in _rows(stages["mixture"]):
        counted[doc_id] = counted.get(doc_id, 0) + 1
    assert counted == {i: n for i, n in wanted.items() if n}


def test_token_files_hold_the_mixture(stages):
    got = sorted(stages["tokens"].collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.occurrence))
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == ids_of(_rows(stages["mixture"]))


def test_an_empty_table_gives_an_empty_result(spark, stages):
    docs = stages["documents"].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered():
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        name if name == "pipeline" else name[:name.index("_") + 1] for name in registry.queries()
        if name == "pipeline" or name.startswith("op")
    }


def test_different_texts_of_one_id_are_judged_each_by_itself(spark, tmp_path):
    item, schema = "how many whole apples are in seven full baskets today", "doc_id long, text string, source string"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [" ".join(f"{letter}{i}" for i in range(30)) for letter in "abcd"]
    rows = [(7, texts[0], "x"), (7, texts[1], "x"), (7, f"{texts[2]} {item}", "x"), (8, texts[1], "x"), (3, texts[3], "y"),
            (3, texts[3], "x"), (None, texts[3], "x"), (None, "p q r s t u", "x"), (None, "no id either", "x")]
    kept = []
    for order in (rows, rows[::-1]):
        docs = corpus_pipeline.near_copies(spark, spark.createDataFrame(order, schema).repartition(3), "").cache()
        kept.append(sorted((tuple(r) for r in docs.collect()), key=str))
    assert kept[0] == kept[1]
    # One of the two equal texts of id 3 stays, whatever its source; id 8 is a copy of a text of id 7.
    assert [r[:2] for r in kept[0]] == [r[:2] for r in sorted([*rows[:3], rows[4], *rows[7:]], key=str)]
    clean = corpus_pipeline.benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in clean), key=str) == [r for r in kept[0] if item not in r[1]]


def test_texts_alone_in_their_class_are_not_shuffled_again(spark, monkeypatch):
    monkeypatch.setattr(common, "FILTER_ROWS", 512)
    rows = unrelated(600, words=120)
    rows += [(900, rows[8][1]), (901, rows[9][1] + " more"), (30, rows[30][1]), (None, "no id"), (902, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    kept, moved = shuffled_bytes(corpus_pipeline.near_copies(spark, docs, ""))
    assert sorted(map(tuple, kept), key=str) == sorted([*rows[:600], *rows[603:]], key=str)
    assert moved < sum(len(text) for _, text in rows[:600]) / 4
