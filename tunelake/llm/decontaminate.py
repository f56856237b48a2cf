"""Benchmark decontamination: windows of a benchmark item's size, found by SimHash and compared exactly.

A window is as many words in a row as the item has; a document with fewer words than the item is one window, where
it has enough shingles to be similar to the item at all. A window's fingerprint has 64 bits, the majorities over the hashes of
its word shingles (each as often as it occurs). Fingerprints of the items of one size are kept in a multi-index:
the 64 bits are cut into blocks, and for a radius ``r`` any fingerprint within it differs by at most
``r // blocks`` bits in some block; a table per block lists, for each value of the block, the items within that
distance, so every item within the radius is found. Found pairs are then compared by the exact similarity of their
shingle multisets (weighted Jaccard); the best window per document and item is returned.

A window that shares no shingle with any item cannot be similar to one, so fingerprints are made only for windows
that hold a shingle of an item of their size. That drops no result.

Rules: null and empty texts hold nothing, and items without words match nothing; an item of one to four words is
one shingle and matches where exactly these words stand. Rows without id are searched, their id stays null;
repeated rows give repeated findings, repeated item ids are separate items whose findings are merged by the best.
Other columns are not read. Whole texts are searched.

The index is broadcast for at most ``ITEMS_AT_ONCE`` items of ``WORDS_AT_ONCE`` words together; more items are
searched in as many passes as needed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import (
    SHINGLE_WORDS, distinct, mixed, sequence_hashes, shingle_hashes, weighted_jaccard, word_hashes, worker_state,
)

SIMILARITY = 0.8
#: At a weighted similarity of 0.8 fingerprints differ by 9.7 bits on average, with a deviation of 2.9.
RADIUS = 24
BLOCKS = 4
BITS = 64
ITEMS_AT_ONCE = 50_000
WORDS_AT_ONCE = 5_000_000
#: Windows fingerprinted at once.
_WINDOWS = 4096

_ROUGH_BITS = 24
_ROUGH_SHIFT = np.uint64(64 - _ROUGH_BITS)

_BIT_COUNTS = np.array([bin(value).count("1") for value in range(1 << 16)], np.uint8)


def signs(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash as 1 and -1."""
    spread = np.unpackbits(mixed(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return spread.astype(np.int32) * 2 - 1


def fingerprints(totals: np.ndarray) -> np.ndarray:
    """The majorities as four 16-bit blocks; ties count as 1."""
    return np.packbits(totals >= 0, axis=1).view(np.uint16)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are in an ordered, non-empty array."""
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


class MultiIndex:
    """Items by their fingerprints; finds all within a radius."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        near = radius // BLOCKS
        values = np.arange(1 << 16, dtype=np.uint16)
        # For each block, the items whose block differs by few enough bits, grouped by the value looked up.
        self.tables = []
        for block in range(BLOCKS):
            starts, members = [np.zeros(1, np.int64)], []
            for part in np.array_split(values, max(16, len(prints))):
                close = _BIT_COUNTS[part[:, None] ^ prints[None, :, block]] <= near
                members.append(np.nonzero(close)[1].astype(np.int32))
                starts.append(close.sum(axis=1))
            self.tables.append((np.cumsum(np.concatenate(starts)), np.concatenate(members)))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place, item)`` of all pairs within the radius."""
        found = []
        for block, (starts, members) in enumerate(self.tables):
            values = prints[:, block].astype(np.int64)
            counts = starts[values + 1] - starts[values]
            places = np.repeat(np.arange(len(prints)), counts)
            offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            found.append(places * len(self.prints) + members[starts[values][places] + offsets])
        both = distinct(np.concatenate(found)) if found else np.empty(0, np.int64)
        places, items = np.divmod(both, max(1, len(self.prints)))
        distance = _BIT_COUNTS[prints[places] ^ self.prints[items]].sum(axis=1)
        near = distance <= self.radius
        return places[near], items[near]


class Benchmark:
    """The items by their number of words, with an index for each size."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int = RADIUS, threshold: float = SIMILARITY):
        self.threshold = threshold
        by_size: dict[int, list] = {}
        for item_id, text in items:
            words = word_hashes(text)
            if len(words):
                by_size.setdefault(len(words), []).append((item_id, shingle_hashes(words)))
        self.sizes = {}
        for size, members in by_size.items():
            shingles = distinct(np.concatenate([own for _, own in members]))
            prints = fingerprints(np.stack([signs(own).sum(axis=0) for _, own in members]))
            self.sizes[size] = (members, shingles, MultiIndex(prints, radius))
        kept = [shingles for size, (_, shingles, _) in self.sizes.items() if size >= SHINGLE_WORDS]
        self.shingles = distinct(np.concatenate(kept)) if kept else np.empty(0, np.uint64)
        # Most shingles of a document are in no item: a table by the first bits of their hash rules them out.
        self.rough = np.zeros(1 << _ROUGH_BITS, bool)
        self.rough[(self.shingles >> _ROUGH_SHIFT).astype(np.int64)] = True
        self.short = [size for size in self.sizes if size < SHINGLE_WORDS]

    def matches(self, text: str | None) -> list[tuple[int | None, float, int, int]]:
        """``item id, similarity, first word, words`` of the best window for each item that the text holds."""
        words = word_hashes(text)
        best: dict[int | None, tuple[float, int, int]] = {}
        for size in self.short:
            if len(words) >= size:
                own = mixed(sequence_hashes(words, size) + np.uint64(size))
                self._search(own, 1, size, best)
        if len(words) >= SHINGLE_WORDS and len(self.shingles):
            own = shingle_hashes(words)
            maybe = np.nonzero(self.rough[(own >> _ROUGH_SHIFT).astype(np.int64)])[0]
            maybe = maybe[_among(own[maybe], self.shingles)]
            if len(maybe):
                for size in self.sizes:
                    width = size - SHINGLE_WORDS + 1
                    if SHINGLE_WORDS <= size <= len(words):
                        self._search(own, width, size, best, maybe)
                    elif size > len(words) and len(own) >= self.threshold * width - 1e-9:
                        # The item has more words: the document is its only window, of fewer shingles.
                        self._search(own, len(own), size, best, maybe)
        return [
            (item, round(value, 6), start, min(size, len(words))) for item, (value, start, size) in best.items()
        ]

    def _search(self, own: np.ndarray, width: int, size: int, best: dict, maybe: np.ndarray | None = None) -> None:
        """Compares all windows of ``width`` shingles that hold a shingle of an item of this size."""
        members, shingles, index = self.sizes[size]
        maybe = np.arange(len(own)) if maybe is None else maybe
        hits = maybe[_among(own[maybe], shingles)]
        if not len(hits):
            return
        reach = np.zeros(len(own) + 1, np.int64)
        np.add.at(reach, np.maximum(hits - width + 1, 0), 1)
        np.add.at(reach, np.minimum(hits, len(own) - width) + 1, -1)
        starts = np.nonzero(np.cumsum(reach)[:len(own) - width + 1] > 0)[0]
        for run in np.split(starts, np.nonzero(np.diff(starts) != 1)[0] + 1):
            for begin in range(0, len(run), _WINDOWS):
                part = run[begin:begin + _WINDOWS]
                totals = np.zeros((len(part) + width, BITS), np.int32)
                np.cumsum(signs(own[part[0]:part[-1] + width]), axis=0, out=totals[1:])
                places, items = index.within(fingerprints(totals[width:] - totals[:-width]))
                for place, item in zip(places.tolist(), items.tolist(), strict=True):
                    start = int(part[place])
                    item_id, wanted = members[item]
                    value = weighted_jaccard(own[start:start + width], wanted)
                    if value >= self.threshold and value > best.get(item_id, (0.0,))[0]:
                        best[item_id] = (value, start, size)


def _index(shared, radius: int, threshold: float) -> Benchmark:
    """The index of a broadcast list of items; a worker serves many tasks and builds it once."""
    key = f"benchmark {shared._path}-{radius}-{threshold}"
    return worker_state(key, lambda: Benchmark(shared.value, radius, threshold))


def _passes(items: DataFrame) -> int:
    size = items.agg(
        F.count("*").alias("items"), F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0)).alias("words")
    ).first()
    return max(1, -(-size["items"] // ITEMS_AT_ONCE), -(-size["words"] // WORDS_AT_ONCE))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """One row per document and item found: ``doc_id, item_id, similarity, first_word, n_words``."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    passes, found = _passes(items), None
    for number in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).collect()
        shared = spark.sparkContext.broadcast(sorted((tuple(row) for row in rows), key=str))

        def searched(batches, shared=shared):
            index = _index(shared, radius, threshold)
            for batch in batches:
                hits = [
                    (doc_id, *match) for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for match in index.matches(text)
                ]
                out = pd.DataFrame(hits, columns=["doc_id", "item_id", "similarity", "first_word", "n_words"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        one = texts.mapInPandas(searched, schema)
        found = one if found is None else found.unionByName(one)
    return found
