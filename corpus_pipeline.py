"""From raw documents to token files: each stage works on what the one before has kept.

1. ``language``: documents whose language cannot be told go (no letter, or no language with a mean probability of
   ``LEAST_PROBABLE``); the others keep their rows as they are.
2. ``near_copies``: one document of each group of near-copies stays, the one with the smallest id.
3. ``benchmark``: documents that hold a benchmark item go.
4. ``mixture``: sources are mixed to their target weights; a document stands as often as the mix takes it.
5. ``tokens``: the documents become token files; the rows are the files' contents, read back by key.

Null and empty texts have no letter, so they go in the first stage. In the second and third a document is an id and
a text, told apart by a 64-bit hash of both: different texts of one id, or of no id, are judged each by itself.
Repeated rows of the document that stays are one document in the second stage; of rows that differ in other columns
the one with the smallest hash stays. Rows without id come after all others there.
Columns that are not named by an operator are handed through, whatever their names. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import bag_minhash, decontaminate, language_id, mixing, token_files
from tunelake.llm.common import perhaps_among, written
from tunelake.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Four languages at random would have 0.25 each; text of one language has 0.45 and more.
LEAST_PROBABLE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    network = language_id.learnt_network(docs)
    found = language_id.identify(docs.select(F.struct(*docs.columns).alias("given")), network, "given.text")
    kept = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_PROBABLE)
    return found.where(kept).select("given.*")


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows whole, and beside them their ``id``, a hash of id and text as ``doc_id``, and ``text``."""
    own = F.col("doc_id").cast("long")
    return docs.select(
        F.struct(*docs.columns).alias("given"), own.alias("id"),
        F.xxhash64(F.lit(17), own, F.coalesce(F.col("text"), F.lit(""))).alias("doc_id"), F.col("text").alias("text"),
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are alone in their class pass as they are; only the others' are shuffled, see ``perhaps_among``."""
    keyed = _keyed(docs)
    classes = bag_minhash.near_copies(keyed).distinct()
    members = written(
        keyed.groupBy("id", "doc_id").agg(F.count("*").alias("copies")).join(classes, "doc_id"), "class-members"
    )
    smallest = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "doc_id")).alias("smallest")
    found = members.groupBy("class_id").agg(smallest, F.sum("copies").alias("copies"))
    judged = members.join(found.where("copies > 1"), "class_id", "left_semi").select("doc_id")
    told = perhaps_among(keyed, judged)
    chosen = told.where("perhaps").join(found.select("smallest.doc_id"), "doc_id").groupBy("doc_id").agg(
        F.min_by("given", F.xxhash64(F.to_json("given"))).alias("given")
    )
    return told.where("NOT perhaps").select("given.*").unionByName(chosen.select("given.*"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    held = decontaminate.contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return keyed.join(held.select("doc_id").distinct(), "doc_id", "left_anti").select("given.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("mixture", mixture),
    ("tokens", tokens),
]
#: Signatures, networks and tokenizers have no SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
