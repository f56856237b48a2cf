"""Work tables in the shared folder, and the hashing of words and word shingles that several operators use.

A *word* is a run without ASCII white space in the lower-case text. A *shingle* is five words in a row; a text of
one to four words is one shingle of all its words, and a text without words has none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.session import shared_folder

SHINGLE_WORDS = 5
#: Spans of text that a worker remembers (24 bytes each and what is known of them), and none that is longer.
REMEMBERED_SPANS = 1_000_000
REMEMBERED_BYTES = 64
#: Texts are cut into pieces for about so many characters at once.
CHUNK_CHARS = 1_000_000


def work_folder(spark, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark)}/work-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from the loss of executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of the table that ``perhaps_among`` broadcasts, each with the bits of 64 hash places.
FILTER_ROWS = 1 << 17


def perhaps_among(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` with a column ``perhaps``, which is true wherever ``key`` is among ``ids (key)``.

    It is false for nearly all others, as long as the different ids are few beside ``64 * FILTER_ROWS`` (8.4 million):
    with a tenth of that one other row in ten is taken along. So rows that a join would shuffle in vain stay where
    they are; the join itself is still needed. The table broadcast has ``FILTER_ROWS`` rows for any input.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_ROWS))
    word, bit = F.floor(place / 64).cast("long").alias("_word"), (place % 64).cast("int").alias("_bit")
    none = ids.sparkSession.range(FILTER_ROWS).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    own = ids.select(word, bit).select("_word", F.expr("shiftleft(1L, _bit)").alias("_bits"))
    words = none.unionByName(own).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    placed = rows.select("*", word, bit).join(F.broadcast(words), "_word")
    return placed.withColumn("perhaps", F.expr("_bits & shiftleft(1L, _bit) <> 0")).drop("_word", "_bit", "_bits")


def training_row(key: str, modulus: int, held_out: int) -> F.Column:
    """Whether a row may be learnt from, by the crc32 of its id as text; rows without an id may not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus != held_out, F.lit(False))


def held_out_row(key: str, modulus: int, held_out: int) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == held_out, F.lit(False))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers scattered over all 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        values = values + np.uint64(0x9E3779B97F4A7C15)
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASES = (0x9E3779B97F4A7C55, 0xD1342543DE82EF95)  # odd, so that they have inverses modulo 2**64
#: Bytes hashed at once, but for a word that is longer.
_BLOCK_BYTES = 1 << 20
_powers = {base: [np.ones(1, np.uint64), np.ones(1, np.uint64)] for base in _BASES}


def _powers_to(size: int, base: int) -> list[np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    held = _powers[base]
    if len(held[0]) < size:
        size = max(size, 1 << 16)
        for place, factor in enumerate((base, pow(base, -1, 1 << 64))):
            factors = np.full(size, factor, np.uint64)
            factors[0] = 1
            with np.errstate(over="ignore"):
                held[place] = np.multiply.accumulate(factors)
    return held


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, a polynomial from running sums over all bytes."""
    up, down = _powers_to(len(data) + 1, base)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        codes = (sums[ends] - sums[starts]) * down[starts]
    return mixed(codes ^ (ends - starts).astype(np.uint64))


def twofold_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span of bytes, some spans at a time; spans follow one another."""
    hashes = np.empty((2, len(starts)), np.uint64)
    first = 0
    while first < len(starts):
        behind = max(first + 1, int(np.searchsorted(ends, starts[first] + _BLOCK_BYTES, side="right")))
        own, offset = slice(first, behind), starts[first]
        block = data[offset:ends[behind - 1]]
        for row, base in enumerate(_BASES):
            hashes[row, own] = span_hashes(block, starts[own] - offset, ends[own] - offset, base)
        first = behind
    return hashes[0], hashes[1]


def _block_hashes(data: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    return span_hashes(data, edges[::2], edges[1::2])


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word, in order: a polynomial of its bytes, from running sums over the text."""
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    if len(data) <= _BLOCK_BYTES:
        return _block_hashes(data)
    spaces, parts, begin = np.flatnonzero(_SPACE[data]), [], 0
    while begin < len(data):
        behind = np.searchsorted(spaces, begin + _BLOCK_BYTES)
        end = int(spaces[behind]) if behind < len(spaces) else len(data)
        parts.append(_block_hashes(data[begin:end]))
        begin = end
    return np.concatenate(parts)


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order; sorting is many times as fast as hashing them."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


_held: list = [None, None]


def worker_state(key: str, make: Callable):
    """What a Python worker keeps from task to task: one thing only, so that operators do not add up."""
    if _held[0] != key:
        _held[:] = [None, None]
        _held[:] = [key, make()]
    return _held[1]


def release_state() -> None:
    """Let go of what another operator has left in a Python worker, ahead of work that keeps nothing there."""
    worker_state("", lambda: None)


class _Table:
    """Places by two hashes of 64 bits, in the order of the first."""

    def __init__(self, first: np.ndarray, second: np.ndarray, places: np.ndarray):
        self.columns = first, second, places

    def find(self, first: np.ndarray, second: np.ndarray, found: np.ndarray) -> None:
        keys, others, places = self.columns
        if len(keys):
            at = np.minimum(np.searchsorted(keys, first), len(keys) - 1)
            hit = (keys[at] == first) & (others[at] == second)
            found[hit] = places[at[hit]]

    def joined(self, other: _Table) -> _Table:
        at = np.searchsorted(self.columns[0], other.columns[0])
        return _Table(*(np.insert(mine, at, more) for mine, more in zip(self.columns, other.columns, strict=True)))


class SpanPlaces:
    """Places of spans of bytes, told apart by 128 bits of hashes; those of short spans are remembered.

    New spans are looked up in a large sorted table and a small one that joins it now and then.
    """

    def __init__(self):
        self.size = 0
        none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
        self.large, self.small = _Table(*none), _Table(*none)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, add: Callable[[list[bytes], bool], int]) -> np.ndarray:
        """The place of each span.

        ``add(spans, keep)`` puts different new spans at successive places and returns the first; places that are
        not to be kept may be given away again by the next call with ``keep``.
        """
        first, second = twofold_hashes(data, starts, ends)
        places = np.full(len(starts), -1, np.int64)
        self.large.find(first, second, places)
        self.small.find(first, second, places)
        missed = np.flatnonzero(places < 0)
        if not len(missed):
            return places
        short = ends[missed] - starts[missed] <= REMEMBERED_BYTES
        groups = []
        for own in (missed[short], missed[~short]):
            order = own[np.lexsort((second[own], first[own]))]
            apart = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
            groups.append((order, np.concatenate([[0], np.cumsum(apart)]) if len(order) else order))
        keep = self.size + sum(int(number[-1]) + 1 for _, number in groups[:1] if len(number)) <= REMEMBERED_SPANS
        added = []
        for remembered, (order, number) in zip((keep, False), groups, strict=True):
            head = order[np.concatenate([[True], np.diff(number) != 0])] if len(order) else order
            added.append((order, number, head, remembered))
        if not keep:  # both at once, or the second would stand where the first does
            heads = np.concatenate([head for *_, head, _ in added])
            begin = add(self._spans(data, starts, ends, heads), False)
            for order, number, head, _ in added:
                places[order] = begin + number
                begin += len(head)
            return places
        for order, number, head, remembered in added:
            if len(order):
                begin = add(self._spans(data, starts, ends, head), remembered)
                places[order] = begin + number
                if remembered:
                    self._remember(first[head], second[head], begin + np.arange(len(head)))
        return places

    @staticmethod
    def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> list[bytes]:
        return [data[a:b].tobytes() for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)]

    def _remember(self, first: np.ndarray, second: np.ndarray, places: np.ndarray) -> None:
        self.size += len(first)
        self.small = self.small.joined(_Table(first, second, places))
        if len(self.small.columns[0]) > 20_000 + len(self.large.columns[0]) // 4:
            self.large = self.large.joined(self.small)
            self.small = _Table(*(column[:0] for column in self.small.columns))


def pieces_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the texts one after the other, start and end of each run without ASCII white space, and the bounds
    of each text's runs among them."""
    encoded = [text.encode("utf-8", "replace") if text else b"" for text in texts]
    # A line feed behind each text parts its last run from the next text's first.
    data = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1
    return data, edges[::2], edges[1::2], np.searchsorted(edges[::2], np.concatenate([[0], np.cumsum(sizes)]))


class Rows:
    """A growing table of numbers; rows behind the kept ones are written over by the next."""

    def __init__(self, width: int, dtype=np.float32):
        self.held, self.size = np.empty((1024, width), dtype), 0

    def add(self, rows: np.ndarray, keep: bool) -> int:
        """Places rows behind the kept ones, and returns where the first one stands."""
        begin, needed = self.size, self.size + len(rows)
        if needed > len(self.held):
            larger = np.empty((max(needed, 2 * self.size), self.held.shape[1]), self.held.dtype)
            larger[:begin] = self.held[:begin]
            self.held = larger
        self.held[begin:needed] = rows
        if keep:
            self.size = needed
        return begin


def text_chunks(texts: list[str | None], chars: int | None = None) -> Iterator[list[str | None]]:
    """Texts in order, about ``CHUNK_CHARS`` characters at once, or one text."""
    most = CHUNK_CHARS if chars is None else chars
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text) if text else 0
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` values in a row."""
    count = len(hashes) - length + 1
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for place in range(length):
            total = total * np.uint64(0x100000001B3) + hashes[place:place + count]
    return mixed(total)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash of every shingle, in order; the hash of a short text depends on its number of words too."""
    if not len(words):
        return words
    if len(words) < size:
        return mixed(sequence_hashes(words, len(words)) + np.uint64(len(words)))
    return sequence_hashes(words, size)


def weighted_jaccard(first: np.ndarray, second: np.ndarray) -> float:
    """Shared part of two multisets: sum of the smaller counts over the sum of the larger ones; 0 if both are empty."""
    if not len(first) or not len(second):
        return 0.0
    a, times_a = np.unique(first, return_counts=True)
    b, times_b = np.unique(second, return_counts=True)
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(times_a[in_a], times_b[in_b]).sum())
    return shared / (len(first) + len(second) - shared)


class Best:
    """The best ``count`` scores of each slot, ties to the smaller id."""

    def __init__(self, slots: int, count: int, dtype=np.int64):
        self.count = count
        self.scores, self.ids = np.zeros((slots, count), dtype), np.zeros((slots, count), np.int64)
        self.held = np.zeros(slots, np.int64)
        self.worst = np.full(slots, -np.inf)  # a score below this one is of no use

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        touched = np.unique(slots)
        row, place = np.nonzero(self.held[touched][:, None] > np.arange(self.count)[None, :])
        old = touched[row]
        slots = np.concatenate([old, slots])
        scores = np.concatenate([self.scores[old, place], scores])
        ids = np.concatenate([self.ids[old, place], ids])
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        sizes = np.diff(np.append(first, len(slots)))
        rank = np.arange(len(slots)) - np.repeat(first, sizes)
        kept = rank < self.count
        self.scores[slots[kept], rank[kept]] = scores[kept]
        self.ids[slots[kept], rank[kept]] = ids[kept]
        self.held[touched] = np.minimum(sizes, self.count)
        full = touched[sizes >= self.count]
        self.worst[full] = self.scores[full, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots, scores and ids, all that is held."""
        slot, place = np.nonzero(self.held[:, None] > np.arange(self.count)[None, :])
        return slot, self.scores[slot, place], self.ids[slot, place]


#: Components of the vectors that a task gathers before it works on them.
CHUNK_NUMBERS = 4_000_000


def vector_chunks(batches: Iterable[pd.DataFrame], most: int) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows with a ``vector`` by its size, about ``most`` rows or ``CHUNK_NUMBERS`` components at a time."""
    held: dict[int, list] = {}
    for batch in batches:
        for size, own in batch.groupby(batch["vector"].map(len), sort=False):
            parts = held.setdefault(size, [])
            parts.append(own)
            rows = sum(map(len, parts))
            if rows >= most or rows * size >= CHUNK_NUMBERS:
                yield size, pd.concat(parts)
                held[size] = []
    for size, parts in held.items():
        if parts:
            yield size, pd.concat(parts)
