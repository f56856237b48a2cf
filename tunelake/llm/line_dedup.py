"""Near-copies of lines: the segment-partition join for an edit distance of at most ``EDITS``.

Two lines within ``k`` edits share one of the ``k + 1`` segments of the shorter line, near the place where it stands
there. Every line is entered in an index under its length and its segments, and asks for the substrings that such a
segment could be, for every length it may be linked to; only the starts are asked that leave enough edits for both
sides. Equal keys meet by a shuffle of hashes alone, sorted and read as a stream. Candidates are verified by a
banded bit-parallel edit distance.

A key with more than ``HOT_LINES`` lines is not paired in the stream: its lines are cut into blocks of about
``BLOCK_LINES``, every block meets every other one, and only links leave the comparison, after a filter by character
counts that drops no link.

Lines are what line feeds separate, as they stand; blank ones take no part. Equal lines are one line (told apart by
64-bit hashes). Lines of fewer than ``SHORT`` characters are copies only when equal.

Rules: a null or empty text has no lines. Rows without id take part, their lines come first in a class; repeated
rows are further copies of their lines. Other columns are not read. An empty table gives an empty table. Whole texts
and whole lines are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import mixed, span_hashes, text_chunks, written
from tunelake.llm.components import components

EDITS = 2
SHORT = 12
HOT_LINES = 64
BLOCK_LINES = 256
#: Up to so many line ids (8 bytes each) are broadcast to pick the texts of candidates; beyond that Spark shuffles.
BROADCAST_IDS = 500_000
_INDEXED, _ASKED = 1, 2


# --- keys and edit distance -----------------------------------------------------------------------------

def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of the ``edits + 1`` segments of a line, the longer ones last."""
    size, longer = divmod(length, edits + 1)
    found, start = [], 0
    for number in range(edits + 1):
        own = size + (number >= edits + 1 - longer)
        found.append((start, own))
        start += own
    return found


def asked_starts(length: int, other: int, number: int, start: int, edits: int) -> range:
    """Where a line of ``length`` may hold segment ``number`` of a line of length ``other``, not longer than it.

    With ``number`` segments before and ``edits - number`` behind it, the part before takes at most ``number`` edits
    or an earlier segment would match too, and likewise the part behind.
    """
    more = length - other
    low = max(start - number, start + more - (edits - number))
    high = min(start + number, start + more + (edits - number))
    return range(low, high + 1)


def batch_keys(lines: list[str], edits: int = EDITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of lines, the hashes under which they are entered or ask, and which of both.

    All substrings of the lines are hashed from running sums over their characters.
    """
    data = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    begins = np.cumsum(lengths) - lengths
    numbers, starts, ends, names, roles = [], [], [], [], []
    for shorter in range(edits + 1):
        own = np.flatnonzero(lengths - shorter >= SHORT)
        other = lengths[own] - shorter
        size, longer = np.divmod(other, edits + 1)
        for number in range(edits + 1):
            width = size + (number >= edits + 1 - longer)
            start = number * size + np.maximum(0, number - (edits + 1 - longer))
            for at in asked_starts(shorter, 0, number, 0, edits):
                inside = np.flatnonzero((start + at >= 0) & (start + at + width <= lengths[own]))
                first = (begins[own] + start + at)[inside]
                numbers.append(own[inside])
                starts.append(first)
                ends.append(first + width[inside])
                names.append(other[inside] * (edits + 1) + number)
                roles.append(np.full(len(inside), _INDEXED | _ASKED if shorter == at == 0 else _ASKED, np.int8))
    numbers, starts, ends, names, roles = (np.concatenate(parts) for parts in (numbers, starts, ends, names, roles))
    hashes = span_hashes(data, starts, ends) ^ mixed(names.astype(np.uint64))
    return numbers, mixed(hashes).view(np.int64), roles


def line_keys(line: str, edits: int = EDITS) -> dict[int, int]:
    """The hashes under which a line is entered or asks, and which of both."""
    keys: dict[int, int] = {}
    for _, key, role in zip(*(column.tolist() for column in batch_keys([line], edits)), strict=True):
        keys[key] = keys.get(key, 0) | role
    return keys


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether two lines are at most ``edits`` insertions, deletions and replacements apart.

    Column by column, bits hold the vertical differences of the ``2 * edits + 1`` rows around the diagonal. The
    distance is followed down the lower edge of the band, and along the last row once the edge has passed it.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    first = 0
    for first, (x, y) in enumerate(zip(a, b)):  # noqa: B007
        if x != y:
            break
    else:
        return True  # the longer one only goes on
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[first:len(a) - last], b[first:len(b) - last]
    rows, width = len(a), 2 * edits + 1
    if rows <= edits or len(b) <= edits:
        return _distance(a, b) <= edits
    full = (1 << width) - 1
    up = full ^ ((1 << edits) - 1)  # before the first column every row adds one; rows above the first add nothing
    down, distance = 0, edits
    for column in range(1, len(b) + 1):
        top, equal = column - edits, 0
        for bit in range(max(0, 1 - top), min(width, rows - top + 1)):
            if a[top + bit - 1] == b[column - 1]:
                equal |= 1 << bit
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & full
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        if column + edits <= rows:
            distance += 1 - (diagonal >> (width - 1) & 1)
        else:
            bit = rows - top
            distance += (right_up >> bit & 1) - (right_down >> bit & 1)
        below = diagonal >> 1
        up = (right_down | ~(below | right_up)) & full
        down = right_up & below
    return distance <= edits


def _distance(a: str, b: str) -> int:
    """Edit distance by rows, for a few characters."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


# --- tasks ----------------------------------------------------------------------------------------------

def _keyed(edits: int):
    def keyed(batches):
        for batch in batches:
            different = dict(zip(batch["line_id"].tolist(), batch["line"], strict=True))
            ids, begin = np.fromiter(different, np.int64, len(different)), 0
            for lines in text_chunks(list(different.values())):
                numbers, keys, roles = batch_keys(lines, edits)
                yield pd.DataFrame({"key": keys, "line_id": ids[begin + numbers], "role": roles})
                begin += len(lines)

    return keyed


def _paired(batches):
    """Reads rows sorted by key and id; yields pairs ``a, b`` of a key, or the lines of a hot key one by one."""
    held = np.empty((0, 3), np.int64)
    hot_key = None
    for batch in _then_none(batches):
        rows = held
        if batch is not None:
            rows = np.concatenate([held, batch[["key", "line_id", "role"]].to_numpy(np.int64)])
        if not len(rows):
            continue
        first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
        roles = np.bitwise_or.reduceat(rows[:, 2], first)
        rows = np.column_stack([rows[first, :2], roles])
        starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        ends = np.append(starts[1:], len(rows))
        out: list[tuple] = []
        if batch is None:
            held = np.empty((0, 3), np.int64)
        else:  # the last key may go on in the next batch
            held = rows[starts[-1]:]
            if len(held) > HOT_LINES or held[0, 0] == hot_key:
                hot_key = held[0, 0]
                out += [(int(i), None, int(hot_key), int(role)) for _, i, role in held]
                held = held[:0]
            starts, ends = starts[:-1], ends[:-1]
        for start, end in zip(*(x[ends - starts > 1 - (rows[starts, 0] == hot_key)].tolist() for x in (starts, ends)), strict=True):
            key, own = int(rows[start, 0]), rows[start:end]
            if end - start > HOT_LINES or key == hot_key:
                out += [(int(i), None, key, int(role)) for _, i, role in own]
                continue
            indexed, asked = own[own[:, 2] & _INDEXED > 0, 1], own[own[:, 2] & _ASKED > 0, 1]
            out += [(min(i, j), max(i, j), None, None) for i in indexed.tolist() for j in asked.tolist() if i != j]
        yield pd.DataFrame(list(set(out)), columns=["a", "b", "hot_key", "role"]).astype("Int64")


def _then_none(batches):
    yield from batches
    yield None


def _verified(edits: int):
    def verified(batches):
        for batch in batches:
            kept = [within(a, b, edits) for a, b in zip(batch["line_a"], batch["line_b"], strict=True)]
            yield batch.loc[kept, ["a", "b"]]

    return verified


def _character_counts(lines) -> np.ndarray:
    counts = np.zeros((len(lines), 64), np.int32)
    for place, line in enumerate(lines):
        for character, times in Counter(line).items():
            counts[place, ord(character) & 63] += times
    return counts


def _blocks_compared(edits: int):
    """Pairs within ``edits`` of two blocks of lines of a hot key; an edit changes two counts by one at most."""
    def compared(batches):
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                one, other = _character_counts(row.lines), _character_counts(row.other_lines)
                for place, line_id in enumerate(row.ids):
                    near = np.abs(other - one[place]).sum(axis=1) <= 2 * edits
                    near &= row.other_ids > line_id if row.block == row.other_block else row.other_ids != line_id
                    found += [
                        sorted((int(line_id), int(row.other_ids[hit]))) for hit in np.flatnonzero(near)
                        if within(row.lines[place], row.other_lines[hit], edits)
                    ]
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return compared


# --- the join -------------------------------------------------------------------------------------------

def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line_id, line`` of every line that is not blank."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line")
    ).where(F.trim(F.regexp_replace("line", r"[\t\r\f\x0B]", "")) != "").select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), F.xxhash64("line").alias("line_id"), "line"
    )


def _hot_links(hot: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Links among the lines ``hot (hot_key, line_id)`` of each hot key."""
    counted = hot.join(hot.groupBy("hot_key").agg(F.count("*").alias("members")), "hot_key").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK_LINES).cast("long")
    )
    member = F.struct("line_id", "line")
    blocks = written(
        counted.join(texts, "line_id").withColumn("block", F.pmod(F.xxhash64("line_id"), "blocks"))
        .groupBy("hot_key", "blocks", "block").agg(F.collect_list(member).alias("members")).select(
            "hot_key", "blocks", "block", F.transform("members", lambda m: m["line_id"]).alias("ids"),
            F.transform("members", lambda m: m["line"]).alias("lines"),
        ), "line-blocks",
    )
    other = blocks.select(
        "hot_key", F.col("block").alias("other_block"), F.col("ids").alias("other_ids"), F.col("lines").alias("other_lines")
    )
    met = blocks.withColumn("other_block", F.explode(F.sequence("block", F.col("blocks") - 1))).join(
        other, ["hot_key", "other_block"]
    ).drop("hot_key", "blocks")
    return met.mapInPandas(_blocks_compared(edits), "a long, b long")


def line_links(given: DataFrame, edits: int = EDITS) -> DataFrame:
    """``a, b``: ids of different lines of ``given (line_id, line)`` within ``edits`` of each other, each pair once."""
    long_lines = given.where(F.length("line") >= SHORT).select("line_id", "line")
    keys = long_lines.mapInPandas(_keyed(edits), "key long, line_id long, role byte")
    candidates = written(
        keys.repartition("key").sortWithinPartitions("key", "line_id").mapInPandas(
            _paired, "a long, b long, hot_key long, role long"
        ), "line-candidates",
    )
    pairs = written(candidates.where("b IS NOT NULL").select("a", "b").distinct(), "line-pairs")
    # A key under which no line is entered pairs none of those that ask for it.
    by_key = candidates.where("hot_key IS NOT NULL")
    entered = by_key.groupBy("hot_key").agg(F.max(F.col("role").bitwiseAND(_INDEXED)).alias("entered")).where("entered > 0")
    hot = written(
        by_key.join(entered, "hot_key").select("hot_key", F.col("a").alias("line_id")).distinct(), "hot-lines"
    )
    ids = written(
        pairs.select(F.col("a").alias("line_id")).unionByName(pairs.select(F.col("b").alias("line_id")))
        .unionByName(hot.select("line_id")).distinct(), "candidate-lines",
    )
    picked = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = written(
        long_lines.join(picked, "line_id").groupBy("line_id").agg(F.first("line").alias("line")), "candidate-texts"
    )
    with_a = pairs.join(texts.select(F.col("line_id").alias("a"), F.col("line").alias("line_a")), "a")
    with_both = with_a.join(texts.select(F.col("line_id").alias("b"), F.col("line").alias("line_b")), "b")
    verified = with_both.select("a", "b", "line_a", "line_b").mapInPandas(_verified(edits), "a long, b long")
    return verified.unionByName(_hot_links(hot, texts, edits)).distinct()


def near_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """One row per line: ``doc_id, line_no, class_doc_id, class_line_no, links, kept``.

    A class holds equal lines and all that links join; it is named by its first line in order of document and line,
    which alone is ``kept``. ``links`` counts the different lines within ``edits`` of a line.
    """
    found = lines(docs)
    linked = written(line_links(found, edits), "line-links")
    classes = components(linked)
    both = linked.select(F.col("a").alias("node")).unionByName(linked.select(F.col("b").alias("node")))
    joined = written(
        classes.join(both.groupBy("node").agg(F.count("*").alias("links")), "node").withColumnRenamed("node", "line_id"),
        "line-classes",
    )
    placed = written(
        found.select("doc_id", "line_no", "line_id").join(joined, "line_id", "left").select(
            "doc_id", "line_no", F.coalesce("root", "line_id").alias("root"),
            F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        ), "lines",
    )
    place = F.struct("doc_id", "line_no")
    heads = placed.groupBy("root").agg(F.min(place).alias("head"))
    return placed.join(heads, "root").select(
        "doc_id", "line_no", F.col("head.doc_id").alias("class_doc_id"), F.col("head.line_no").alias("class_line_no"),
        "links", place.eqNullSafe(F.col("head")).alias("kept"),
    )
