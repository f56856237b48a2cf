"""The registered queries of the training-data operators: thin digests of what each operator returns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import (
    bag_minhash, chat_format, decontaminate, hard_negatives, language_id, license_scan, line_dedup, mixing,
    periodic_runs, statements, token_files, toxicity, vptree, warc,
)
from tunelake.llm.common import held_out_row

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The pages given have no capture time.
CAPTURED = "2024-01-01T00:00:00Z"
TRICKY_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted; the digests are of what is read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = given.unionByName(tricky.withColumn("text", F.lit(TRICKY_TEXT)))
    flat = chat_format.flatten_parts(turns.withColumn("parts", chat_format.text_part(F.col("text"))))
    return digests(chat_format.format_conversations(flat))


def digests(formatted: DataFrame) -> DataFrame:
    back = chat_format.read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(length(role) + length(text) + 14
           + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', ''))
           + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', ''))
       ) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1, no document beyond three times."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and the conversion record of every page."""
    responses = warc.page_responses(table(spark, sf_dir, "pages"), CAPTURED)
    return warc.derivatives(responses).withColumn("page_id", F.col("source_key").cast("long")).drop(
        "source_key", "record"
    )


def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-copy class of every document: ``doc_id, class_id``."""
    return bag_minhash.near_copies(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class and the number of links of every line."""
    return line_dedup.near_lines(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it holds, with the best window."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path() -> str:
    """The tokenizer that the queries use; the operators take its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back by key: ``doc_id, start, n_tokens, ids_crc32``."""
    index = token_files.write(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_files.read(index)


def op8_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector: ``query_id, rank, vec_id, score``; exact search."""
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document: ``doc_id, held_out, score, predicted``; learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), toxicity.learning_rule())
    return toxicity.scored(docs, model).select(
        "doc_id", held_out_row("doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("passages"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from three quarters of them: ``doc_id, held_out, lang_pred, score``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language_id.learnt_network(docs, language_id.learning_rule())
    found = language_id.identify(docs.select("doc_id", "text"), network)
    return found.select("doc_id", held_out_row("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def repeated_order(doc_id: str | None, count: int) -> np.ndarray | None:
    """For a tenth of the documents, by the crc32 of their ids, the words from some word on repeat those before."""
    code = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if code % 10:
        return None
    first = code // 10 % count
    period = 1 + (count - first) // (3 + code // 10 % 8)
    number = np.arange(count)
    return np.where(number < first, number, first + (number - first) % period)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document's words, the one with most periods, and what is left without the repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.run_digests(docs, repeated_order, "doc_id").drop("text")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license phrases and notices of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "notices")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector; every seventh has the label after its own."""
    given = table(spark, sf_dir, "embeddings").where("vec_id IS NOT NULL AND label IS NOT NULL")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.quantised(given.withColumn("label", moved))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


_QUERIES: dict[str, Query] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_mixing": op2_mixing,
    "op3_warc_derivatives": op3_warc_derivatives,
    "op4_bag_minhash": op4_bag_minhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_token_files": op7_token_files,
    "op8_vantage_point_trees": op8_vantage_point_trees,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
_STATEMENTS = {
    "op1_chat_formatting": OP1_SQL,
    "op11_periodic_runs": statements.OP11_SQL,
    "op12_license_scan": statements.OP12_SQL,
    "op13_hard_negatives": statements.OP13_SQL,
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_STATEMENTS)
