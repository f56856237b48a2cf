"""Near-copies by BagMinHash: signatures whose entries agree with the probability of the weighted Jaccard similarity.

A document is the multiset of its word shingles. The weight (count) of a shingle is cut into the levels [0, 1),
[1, 2), [2, 4), [4, 8) and so on. On every level the shingle has a Poisson process whose points depend on the
shingle and the level only: a point has a time, an entry of the signature, and a place within the level, and it
counts if its place lies below the weight. A partly filled level is thus a thinned process, so that two documents
share exactly the points below the smaller weight. An entry holds its earliest time; generation stops once every
process has passed the latest entry, which takes about ``n + m log m`` points instead of ``n * m``.

Signatures are cut into bands; documents that share a band are candidates. Links are always decided by comparing
the shingle multisets exactly. Exact copies are merged before all this, and within a bucket all members are first
compared with the smallest, so a group of copies costs one pair per member. Members of a bucket that are then
still in different classes may be linked through others: their signatures are compared block by block, and pairs
whose signatures agree in nearly enough entries are compared exactly, the likeliest first, so that most are in one
class before the others are looked at.

Signatures are six times as large as their bands, so only the bands of all documents are written; the few members of
such buckets get their signatures made again. Texts are shuffled for documents that a pair or such a bucket names, and
for the few others that ``perhaps_among`` cannot tell from them.

Rules: a document without words (null or empty text) is alone in its class. Rows without id join the class of
their exact copies and have none otherwise. Rows of one id are one document: its texts share a class. Other
columns are not read. An empty table gives an empty table. Nothing is left out: buckets have no size limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import (
    mixed, perhaps_among, release_state, shingle_hashes, weighted_jaccard, word_hashes, written,
)
from tunelake.llm.components import components, merged

SIMILARITY = 0.8
#: At a similarity of 0.8 a pair shares a band with probability 0.9998, at 0.5 with 0.25, at 0.3 with 0.01.
BANDS, ROWS = 36, 7
BANDED = BANDS * ROWS
#: Entries of a signature; those beyond the bands only sharpen the estimate of a pair's similarity.
ENTRIES = 2 * BANDED
#: Agreement of two signatures from which a pair is compared exactly, the likeliest pairs first. At a similarity of
#: 0.8 the agreement of 504 entries has a deviation of 0.018.
LIKELY = (0.785, 0.745)
#: Members of a bucket whose signatures are compared at once with as many others.
BLOCK_MEMBERS = 256
#: Points generated at once.
_POINTS = 1024


def _uniform(random: np.ndarray) -> np.ndarray:
    return ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signature(elements: np.ndarray, counts: np.ndarray, size: int = ENTRIES) -> np.ndarray:
    """The earliest time of each entry for a multiset of different 64-bit ``elements`` with whole ``counts``."""
    seeds, rates, lows, tops = [mixed(elements)], [np.ones(len(elements))], [np.zeros(len(elements))], [counts]
    low = 1
    while len(elements) and low < counts.max():
        more = counts > low
        seeds.append(mixed(mixed(elements[more]) ^ np.uint64(low)))
        rates.append(np.full(more.sum(), float(low)))
        lows.append(np.full(more.sum(), float(low)))
        tops.append(counts[more])
        low *= 2
    seed, rate = np.concatenate(seeds), np.concatenate(rates)
    lowest, top = np.concatenate(lows), np.concatenate(tops).astype(np.float64)
    earliest = np.full(size, np.inf)
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        block = max(1, _POINTS // len(seed))
        ticks = np.arange(step + 1, step + block + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            random = mixed(seed[:, None] + ticks * np.uint64(0xD1342543DE82EF95))
        gaps = -np.log(_uniform(random)) / rate[:, None]
        gaps[:, 0] += time
        times = np.cumsum(gaps, axis=1)
        entry = (mixed(random) % np.uint64(size)).astype(np.int64)
        if low > 1:
            place = lowest[:, None] + rate[:, None] * _uniform(mixed(random ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            counted = place < top[:, None]
            np.minimum.at(earliest, entry[counted], times[counted])
        else:
            np.minimum.at(earliest, entry.ravel(), times.ravel())
        time, step = times[:, -1], step + block
        going = time < earliest.max()
        if not going.all():
            seed, rate, lowest, top, time = seed[going], rate[going], lowest[going], top[going], time[going]
    return earliest


def band_keys(entries: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    values = entries.view(np.uint64).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        keys = mixed(keys ^ values[:, row])
    return keys.view(np.int64)


def _shortened(entries: np.ndarray) -> bytes:
    """32 bits of each banded entry, 16 bits of the others."""
    short = mixed(entries.view(np.uint64))
    return (short[:BANDED] >> np.uint64(32)).astype("<u4").tobytes() + (
        short[BANDED:] >> np.uint64(48)
    ).astype("<u2").tobytes()


def _restored(entries) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(entries), np.uint8).reshape(len(entries), -1)
    return data[:, :4 * BANDED].copy().view("<u4"), data[:, 4 * BANDED:].copy().view("<u2")


def _signature_of(words: np.ndarray) -> np.ndarray:
    return signature(*np.unique(shingle_hashes(words), return_counts=True))


def _described(batches):
    release_state()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            words = word_hashes(text)
            if not len(words):
                rows.append((doc_id, None, None, None))
                continue
            content = xxhash.xxh3_128_intdigest(words.tobytes())
            low, high = np.array([content & (2**64 - 1), content >> 64], np.uint64).view(np.int64).tolist()
            rows.append((doc_id, low, high, band_keys(_signature_of(words)[:BANDED])))
        described = pd.DataFrame(rows, columns=["doc_id", "low", "high", "bands"])
        for column in ("doc_id", "low", "high"):
            described[column] = described[column].astype("Int64")
        yield described


def _signed(batches):
    release_state()
    for batch in batches:
        words = map(word_hashes, batch["text"])
        rows = [
            (doc_id, _shortened(_signature_of(own))) for doc_id, own in zip(batch["doc_id"], words, strict=True) if len(own)
        ]
        yield pd.DataFrame(rows, columns=["doc_id", "entries"]).astype({"doc_id": "int64"})


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents ``ids (doc_id)``, and of a few others."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    return perhaps_among(texts, ids).where("perhaps").drop("perhaps")


def signatures(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, entries`` of the documents ``ids (doc_id)`` that have words."""
    # No left semi join: Spark would move it ahead of the filter, and shuffle all texts.
    return _texts(docs, ids).join(ids.distinct(), "doc_id").mapInPandas(_signed, "doc_id long, entries binary")


def _similar(threshold: float):
    def compared(batches):
        release_state()
        for batch in batches:
            kept = [
                weighted_jaccard(shingle_hashes(word_hashes(a)), shingle_hashes(word_hashes(b))) >= threshold
                for a, b in zip(batch["text_a"], batch["text_b"], strict=True)
            ]
            yield batch.loc[kept, ["a", "b"]]

    return compared


def links(pairs: DataFrame, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The pairs ``a, b`` whose documents have the similarity wanted, compared exactly."""
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return with_both.select("a", "b", "text_a", "text_b").mapInPandas(_similar(threshold), "a long, b long").distinct()


def _agreeing(least: float, below: float):
    """Pairs of two blocks in different classes whose signatures agree from ``least`` to ``below``.

    A pair is returned for the first band that it shares only.
    """
    def compared(batches):
        release_state()
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                (one, one_more), (other, other_more) = _restored(row.entries), _restored(row.other_entries)
                for place, doc_id in enumerate(row.ids):
                    equal = other == one[place]
                    share = (equal.sum(axis=1) + (other_more == one_more[place]).sum(axis=1)) / ENTRIES
                    wanted = (share >= least) & (share < below) & (row.other_roots != row.roots[place])
                    wanted &= (row.other_ids > doc_id) if row.block == row.other_block else (row.other_ids != doc_id)
                    hits = np.nonzero(wanted)[0]
                    first = equal[hits].reshape(len(hits), BANDS, ROWS).all(axis=2).argmax(axis=1)
                    found += [(doc_id, int(row.other_ids[hit])) for hit in hits[first == row.band]]
            yield pd.DataFrame([sorted(pair) for pair in found], columns=["a", "b"]).astype("int64")

    return compared


def _apart(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """The members, with their classes, of the buckets that hold more than one class."""
    placed = buckets.join(classes, buckets.doc_id == classes.node, "left").select(
        "key", "band", "doc_id", F.coalesce("root", "doc_id").alias("root")
    )
    several = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    ).where("low < high")
    return placed.join(several, "key").select(
        "key", "band", "doc_id", "root", F.ceil(F.col("members") / BLOCK_MEMBERS).cast("long").alias("blocks")
    )


def likely_links(apart: DataFrame, entries: DataFrame, least: float, below: float) -> DataFrame:
    """Pairs ``a, b`` of bucket members in different classes, by the agreement of their signatures.

    Large buckets are cut into blocks of about ``BLOCK_MEMBERS`` by a hash of the id, and every block meets every
    other one of its bucket in a row of its own; only the pairs that agree leave the comparison.
    """
    sides = ("block", "ids", "roots", "entries")

    def gathered(members: DataFrame) -> DataFrame:
        member = F.struct("doc_id", "root", "entries")
        return members.join(entries, "doc_id").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")).groupBy(
            "key", "band", "blocks", "block"
        ).agg(F.collect_list(member).alias("members")).select(
            "key", "band", "blocks", "block", F.transform("members", lambda m: m["doc_id"]).alias("ids"),
            F.transform("members", lambda m: m["root"]).alias("roots"),
            F.transform("members", lambda m: m["entries"]).alias("entries"),
        )

    compared = _agreeing(least, below)
    alone = gathered(apart.where("blocks = 1"))
    with_itself = alone.select("band", *sides, *(F.col(name).alias(f"other_{name}") for name in sides))
    found = with_itself.mapInPandas(compared, "a long, b long")
    blocks = written(gathered(apart.where("blocks > 1")), "signature-blocks")
    other = blocks.select("key", *(F.col(name).alias(f"other_{name}") for name in sides))
    met = blocks.withColumn("other_block", F.explode(F.sequence("block", F.col("blocks") - 1))).join(
        other, ["key", "other_block"]
    ).select(with_itself.columns)
    return found.unionByName(met.mapInPandas(compared, "a long, b long")).distinct()


def near_copies(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` for every row of ``docs (doc_id, text)``; the class id is the smallest id of the class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = written(
        docs.mapInPandas(_described, "doc_id long, low long, high long, bands array<long>"), "bag-minhash"
    )
    exact = written(
        described.where("low IS NOT NULL").groupBy("low", "high").agg(F.min("doc_id").alias("original")), "exact-copies"
    )
    in_exact = described.join(exact, ["low", "high"])
    members = in_exact.where("doc_id = original").select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last")
    buckets = written(members.join(shared, "key").select("key", "band", "hub", "doc_id").distinct(), "buckets")

    with_hub = written(
        buckets.where("doc_id > hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs"
    )
    several_texts = described.where("low IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("low").alias("one"), F.max("low").alias("other")
    ).where("one <> other").select("doc_id")
    same_id = in_exact.where("doc_id > original").select("doc_id", "original").join(
        several_texts, "doc_id", "left_semi"
    ).select(F.col("original").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = written(links(with_hub, docs, threshold).unionByName(same_id), "links")
    classes = written(components(found), "classes")

    below = 2.0
    for least in LIKELY:
        apart = written(_apart(buckets, classes), "buckets-apart")
        if below > 1.0:  # buckets of one block are done at once; later rounds need no other documents
            # An id with several texts has several signatures; the buckets hold it once.
            entries = written(signatures(docs, apart.select("doc_id")), "signatures")
            small = likely_links(apart.where("blocks = 1"), entries, LIKELY[-1], below)
            likely = small.unionByName(likely_links(apart.where("blocks > 1"), entries, least, below)).distinct()
        else:
            likely = likely_links(apart.where("blocks > 1"), entries, least, below)
        untested = written(likely.join(with_hub, ["a", "b"], "left_anti"), "pairs")
        more = written(links(untested, docs, threshold), "links")
        if not more.isEmpty():
            classes = written(merged(classes, more), "classes")
        below = least

    first_of = described.join(exact, ["low", "high"], "left").select(
        "doc_id", F.coalesce("original", "doc_id").alias("original")
    )
    return first_of.join(classes, first_of["original"] == classes.node, "left").select(
        "doc_id", F.coalesce("root", "original").alias("class_id")
    )
