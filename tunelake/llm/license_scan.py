"""License notices in texts, found by diagonal voting over word grams; column functions only.

Words are runs of ASCII letters and digits and of characters beyond ASCII, ASCII letters in lower case. A template is
a notice as words; a *gram* is ``GRAM_WORDS`` of its words in a row, or all of a shorter template's. The hashes of all
rolling grams of all texts are joined to the templates' (their words are compared too, so a collision matches
nothing). A match votes for its *diagonal*, the word of the text where the template would begin. Votes are merged per
text, template and diagonal before the shuffle.

Words put in or left out move the rest of a notice to a neighbouring diagonal. Diagonals of one template that are not
more than a fifth of its words apart are one span; a template of fewer than five words has no such play. A span is
verified by its words: its matched grams must cover ``LEAST_COVERED`` of the template's words (all, where the
template is ``exact``), and it may be ``MOST_STRETCHED`` times as long as the template at most.

Templates of ``BROADCAST_WORDS`` words in all, or fewer, are broadcast; of more, the join is left to Spark, which splits frequent
grams. A text is known by a 128-bit hash of its id and itself, so that no text is shuffled.

Rules: a null or empty text has no words and no notices. Repeated rows are found once and each get the result; rows
without id and different texts of one id are judged each by itself. Very long texts are read whole. A text with
more than one notice of a kind has all its places counted. Of spans, the highest covered part is the score, 0 without
any; ties do not matter. Other columns stay, but for those named like a result. An empty table gives an empty table;
without templates nothing is found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM_WORDS = 3
LEAST_COVERED = 0.8
MOST_STRETCHED = 1.25
#: Parts of a template's words that its text may move by.
DRIFT = 5
BROADCAST_WORDS = 50_000
#: What stands between two words, once letters are small.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False


# Phrases that a scan must find word by word.
PHRASES = [
    Template("cc-by", "cc by", exact=True),
    Template("gpl", "general public license", exact=True),
    Template("reserved", "all rights reserved", exact=True),
]
# The usual notices of public licenses, by their short names.
NOTICES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    Template("mit", "Released under the MIT License"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def words(text: Column) -> Column:
    """The words of a text in lower case; those of ASCII letters are as if only these had been lowered.

    The Kelvin sign is the one other character that has an ASCII letter as its small one.
    """
    given = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u2126"))
    return F.array_remove(F.split(F.lower(given), BETWEEN), "")


def _grams(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key, place, w0 … `` for every word of ``text`` and those behind it, null behind the last."""
    zipped = ["words"] + [f"slice(words, {n + 1}, greatest(size(words), 1))" for n in range(1, GRAM_WORDS)]
    return rows.select(*key, words(F.col("text")).alias("words")).select(
        *key, F.posexplode(F.expr(f"arrays_zip({', '.join(zipped)})")).alias("place", "gram")
    ).select(*key, "place", *(F.col("gram")[str(n) if n else "words"].alias(f"w{n}") for n in range(GRAM_WORDS)))


#: What a match knows of its template.
_OF_TEMPLATE = ["template", "label", "exact", "size", "k"]


def _template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``template, label, exact, size, k, t_place, t0 …``: the grams of the templates, of two words and more."""
    listed = F.array(*(
        F.struct(
            F.lit(number).alias("template"), F.lit(t.label).alias("label"), F.lit(t.exact).alias("exact"),
            F.lit(t.text).alias("text"),
        ) for number, t in enumerate(templates)
    ))
    whole = spark.range(1).select(F.inline(listed)).withColumn("size", F.size(words(F.col("text"))))
    return _grams(whole.withColumn("k", F.least("size", F.lit(GRAM_WORDS))), _OF_TEMPLATE).where(
        "place <= size - k"
    ).select(
        *_OF_TEMPLATE, F.col("place").alias("t_place"),
        *(F.when(F.lit(n) < F.col("k"), F.col(f"w{n}")).alias(f"t{n}") for n in range(GRAM_WORDS)),
        F.xxhash64("w0", "w1").alias("hash"),
    )


def votes(keyed: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """``k1, k2``, the template, ``diagonal, places``: the template's places that match on each diagonal."""
    grams = _template_grams(keyed.sparkSession, templates)
    if sum(len(t.text) for t in templates) // 2 <= BROADCAST_WORDS:  # a word and what parts it from the next
        grams = F.broadcast(grams)
    given = _grams(keyed, ["k1", "k2"]).where("w1 IS NOT NULL").withColumn("hash", F.xxhash64("w0", "w1"))
    equal = (given["hash"] == grams["hash"]) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1"))
    for n in range(2, GRAM_WORDS):
        equal = equal & (F.col(f"t{n}").isNull() | (F.col(f"w{n}") == F.col(f"t{n}")))
    hits = given.join(grams, equal).withColumn("diagonal", F.col("place") - F.col("t_place"))
    return hits.groupBy("k1", "k2", *_OF_TEMPLATE, "diagonal").agg(F.collect_set("t_place").alias("places"))


def spans(keyed: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """``k1, k2, label, exact, first, behind, covered``: the verified spans; ``covered`` is a part of the template."""
    own = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    play = F.when(F.col("exact"), 0).otherwise(F.floor(F.col("size") / DRIFT))
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > play, F.lit(True))
    chained = votes(keyed, templates).withColumn("apart", apart.cast("long")).withColumn(
        "chain", F.sum("apart").over(own)
    )
    words_of = F.expr("array_distinct(flatten(transform(places, place -> sequence(place, place + k - 1))))")
    merged = chained.groupBy("k1", "k2", *_OF_TEMPLATE, "chain").agg(
        F.min(F.col("diagonal") + F.array_min("places")).cast("long").alias("first"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("k")).cast("long").alias("behind"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
    ).withColumn("words", F.size(words_of))
    least = F.when(F.col("exact"), F.col("size")).otherwise(F.col("size") * LEAST_COVERED)
    return merged.where(F.col("words") >= least).where(
        F.col("behind") - F.col("first") <= F.col("size") * MOST_STRETCHED
    ).select("k1", "k2", "label", "exact", "first", "behind", (F.col("words") / F.col("size")).alias("covered"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``k1, k2`` beside the rows: a hash of id and text, as null and empty texts have the same words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({f"k{n}": F.xxhash64(F.lit(n), F.col("doc_id"), text) for n in (1, 2)})


def _joined_labels(label: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


def scan(docs: DataFrame, templates: Sequence[Template] = (*PHRASES, *NOTICES)) -> DataFrame:
    """``docs (doc_id, text)`` with the notices found.

    ``n_words``; ``n_base, first_word, last_word, base_labels``: places of the exact templates, their first and last
    start and their labels; ``labels``: those of all templates; ``score``: the highest covered part; ``notices``:
    every span as ``label, exact, first, behind, covered``, by ``first``. Places and starts count words from 0.
    """
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices")
    kept = [name for name in docs.columns if name not in (*results, "k1", "k2")]
    keyed = _keyed(docs.select(*kept))
    counted = keyed.select(*kept, "k1", "k2", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    if not templates:
        found = keyed.select("k1", "k2").where(F.lit(False)).selectExpr(
            "*", "'' AS label", "false AS exact", "0L AS first", "0L AS behind", "0D AS covered"
        )
    else:
        found = spans(keyed.select("k1", "k2", "text"), templates)
    base = lambda x: F.when(F.col("exact"), x)
    summed = found.groupBy("k1", "k2").agg(
        F.count(base(F.lit(1))).alias("n_base"), F.min(base(F.col("first"))).alias("first_word"),
        F.max(base(F.col("first"))).alias("last_word"), _joined_labels(base(F.col("label"))).alias("base_labels"),
        _joined_labels(F.col("label")).alias("labels"), F.max("covered").alias("score"),
        F.array_sort(F.collect_list(F.struct("first", "behind", "label", "exact", "covered"))).alias("notices"),
    )
    return counted.join(summed, ["k1", "k2"], "left").select(
        *kept, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "notices",
    )
