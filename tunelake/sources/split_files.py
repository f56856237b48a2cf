"""Records of files that cannot be cut at a line: JSON arrays, and CSV whose cells hold line breaks.

Spark deals such a file to many tasks in pieces that end in a separator, ``}`` or a line feed. Whether a separator
ends a record depends on all that stands before it: on the parity of the quotes and, in JSON, on the depth of the
braces outside quotes. So the files are read twice:

1. Every task sums up its part of a file: the parity of its quotes, and the depth that its braces add if the part
   starts outside a string, and if it starts inside one. That is one line per part. Running sums over the parts of a file give
   the state that each part starts in, and show files that end inside a record or are no array.
2. Every task walks over its part from that state and hands out the records that begin and end in it. What stands
   before the first end and behind the last one are fragments, two per part at most; those of a record are put together by
   a group of their own.

The states of parts that start inside a record are broadcast up to ``BROADCAST_PARTS`` of them; beyond that the
pieces are brought together with the state of their part by a shuffle. Only a record is ever held in one piece.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.session import shared_folder

BROADCAST_PARTS = 100_000
_QUOTE, _BACKSLASH, _OPEN, _CLOSE, _FEED = (ord(c) for c in '"\\{}\n')
_WHOLE, _HEAD, _TAIL, _THROUGH = range(4)
#: What a file that is an array ends with, and an empty array.
_END, _EMPTY = r"^\s*\]\s*$", r"^\ufeff?\s*\[\s*\]\s*$"


@dataclass(frozen=True)
class Format:
    """``separator`` ends each piece; with ``braces`` a record is an object, else what stands between separators."""

    separator: str
    braces: bool


JSON_ARRAY = Format("}", True)
CSV = Format("\n", False)


# --- walking over a part ----------------------------------------------------------------------------------

def quote_marks(data: np.ndarray, escapes: bool) -> np.ndarray:
    """Which bytes are quotes that open or close a string; with ``escapes`` a backslash takes the next byte's meaning."""
    marks = data == _QUOTE
    if not escapes or not (data == _BACKSLASH).any():
        return marks
    place = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _BACKSLASH, place, -1))
    before = np.concatenate([[-1], other[:-1]])  # the last byte before this one that is no backslash
    return marks & ((place - 1 - before) % 2 == 0)


@dataclass
class Walk:
    """Goes over the bytes of a part; ``inside`` a string and ``depth`` are the state it starts in."""

    kind: Format
    inside: int = 0
    depth: int = 0
    open: bytes = b""  # what has been read since the last end of a record
    ended: bool = False  # whether a record has ended in this part
    started: bool = field(init=False)  # whether the part begins between records

    def __post_init__(self):
        self.started = not self.inside and not self.depth

    def records(self, more: bytes) -> Iterator[tuple[int, bytes]]:
        """Whole records, and the fragment before the first end; text between the objects of an array goes."""
        data = np.frombuffer(more, np.uint8)
        marks = quote_marks(data, self.kind.braces)
        inside = (np.cumsum(marks) + self.inside) & 1
        self.inside = int(inside[-1]) if len(inside) else self.inside
        if self.kind.braces:
            step = ((data == _OPEN).astype(np.int64) - (data == _CLOSE)) * (inside == 0)
            depth = np.cumsum(step) + self.depth
            self.depth = int(depth[-1]) if len(depth) else self.depth
            ends = np.flatnonzero((step < 0) & (depth == 0)) + 1
        else:
            ends = np.flatnonzero((data == _FEED) & (inside == 0)) + 1
        begin = 0
        for end in ends.tolist():
            text, self.open, begin = self.open + more[begin:end], b"", end
            yield (_WHOLE if self.ended or self.started else _HEAD), text
            self.ended = True
        self.open += more[begin:]

    def rest(self) -> tuple[int, bytes] | None:
        """What the part ends with, if a record is open; a closed array's end is none."""
        if not self.inside and self.depth <= 0:
            return None
        return (_TAIL if self.ended or self.started else _THROUGH), self.open


def _joined(texts: pd.Series, separator: str) -> bytes:
    return (separator.join(texts) + separator).encode()


def _parts(batches) -> Iterator[tuple[tuple[str, str, int], pd.DataFrame]]:
    """The rows of a batch by the part of a file that they come from, in order."""
    for batch in batches:
        start = batch["part_start"].to_numpy()
        edges = np.flatnonzero((start[1:] != start[:-1]) | (batch["path"].to_numpy()[1:] != batch["path"].to_numpy()[:-1])) + 1
        for own in np.split(np.arange(len(batch)), edges):
            if len(own):
                rows = batch.iloc[own]
                head = rows.iloc[0]
                yield (head["path"], head["file_name"], int(head["part_start"])), rows


def _summed(kind: Format):
    """One line per part: parity of quotes, depth added from outside and from inside a string, first and last text."""
    def line(key, held):
        return pd.DataFrame([(*key, held["parity"], *held["depth"], held["pieces"], held["last"])], columns=_SUMS)

    def summed(batches):
        key, held = None, {}
        for own, rows in _parts(batches):
            if own != key:
                if key is not None:
                    yield line(key, held)
                key, held = own, {"parity": 0, "depth": [0, 0], "pieces": 0, "last": ""}
            data = np.frombuffer(_joined(rows["value"], kind.separator), np.uint8)
            inside = (np.cumsum(quote_marks(data, kind.braces)) + held["parity"]) & 1
            step = (data == _OPEN).astype(np.int64) - (data == _CLOSE)
            for start in (0, 1) if kind.braces else ():
                held["depth"][start] += int(step[inside == start].sum())
            held["parity"] = int(inside[-1])
            held["pieces"] += len(rows)
            held["last"] = rows["value"].iloc[-1][-200:]
        if key is not None:
            yield line(key, held)

    return summed


_SUMS = ["path", "file_name", "part_start", "parity", "outside_depth", "inside_depth", "pieces", "last"]
_SUMS_DDL = (
    "path string, file_name string, part_start long, parity int, outside_depth long, inside_depth long, pieces long, last string"
)


def _walked(kind: Format):
    def walked(batches):
        key, walk, first = None, None, False
        for own, rows in _parts(batches):
            found: list[tuple] = []
            if own != key:
                if walk is not None and (rest := walk.rest()):
                    found.append((*key, first, *rest))
                key, state = own, rows.iloc[0]
                walk, first = Walk(kind, int(state["inside"]), int(state["depth"])), own[2] == 0
            for record in walk.records(_joined(rows["value"], kind.separator)):
                found.append((*key, first, *record))
                first = False
            yield pd.DataFrame([(*row[:-1], row[-1].decode()) for row in found], columns=_FOUND)
        if walk is not None and (rest := walk.rest()):
            yield pd.DataFrame([(*key, first, rest[0], rest[1].decode())], columns=_FOUND)

    return walked


_FOUND = ["path", "file_name", "part_start", "is_first", "kind", "record"]
_FOUND_DDL = "path string, file_name string, part_start long, is_first boolean, kind int, record string"


# --- the files --------------------------------------------------------------------------------------------

def _pieces(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """``value``, and the file and the part of it that a piece begins in."""
    return spark.read.option("lineSep", kind.separator).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("part_start"), "value",
    )


def _states(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """The state that each part starts in, written; files that end inside a record end the load."""
    sums = _pieces(spark, path, kind).mapInPandas(_summed(kind), _SUMS_DDL)
    own = Window.partitionBy("path").orderBy("part_start")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).cast("int"))
    added = F.when(F.col("inside") == 1, F.col("inside_depth")).otherwise(F.col("outside_depth"))
    sums = sums.withColumn("added", added).withColumn("depth", F.coalesce(F.sum("added").over(before), F.lit(0)))
    sums = sums.withColumn("is_last", F.lead("part_start").over(own).isNull())
    folder = f"{shared_folder(spark)}/parts-{uuid.uuid4().hex}"
    sums.write.parquet(folder)
    states = spark.read.schema(sums.schema).parquet(folder)
    unclosed = (F.col("inside") + F.col("parity")) % 2 == 1
    if kind.braces:
        # Each piece was given back the brace that ends it; the last one has none.
        unclosed = unclosed | (F.col("depth") + F.col("added") != -1)
        alone = (F.col("part_start") == 0) & (F.col("pieces") == 1)
        unclosed = unclosed | ~F.when(alone, F.col("last").rlike(_EMPTY)).otherwise(F.col("last").rlike(_END))
    broken = states.where("is_last").where(unclosed).select("file_name").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0].file_name} is malformed: it ends inside a record" + " or is no array" * kind.braces)
    return states.where("inside <> 0 OR depth <> 0").select("path", "part_start", "inside", "depth")


def records(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """``file_name, is_first, record``: the text of every record, in no order.

    What stands between the objects of an array is left in front of them. ``is_first`` marks the record at a file's
    start.
    """
    states = _states(spark, path, kind)
    pieces = _pieces(spark, path, kind)
    if (parts := states.count()) <= BROADCAST_PARTS:
        stated = pieces.join(F.broadcast(states), ["path", "part_start"], "left") if parts else pieces.selectExpr(
            "*", "0 AS inside", "0L AS depth"
        )
    else:
        numbered = pieces.withColumn("_place", F.monotonically_increasing_id())
        stated = numbered.join(states, ["path", "part_start"], "left").repartition("path", "part_start").sortWithinPartitions(
            "path", "part_start", "_place"
        )
    stated = stated.select(
        "path", "file_name", "part_start", F.coalesce("inside", F.lit(0)).alias("inside"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "value",
    )
    found = stated.mapInPandas(_walked(kind), _FOUND_DDL)
    whole = found.where(F.col("kind") == _WHOLE).select("file_name", "is_first", "record")
    # The fragments of a record are a tail, the parts that it runs through, and a head.
    tail = F.col("kind") == _TAIL
    own = Window.partitionBy("path").orderBy("part_start", tail)
    fragments = found.where(F.col("kind") != _WHOLE).withColumn("number", F.sum(tail.cast("long")).over(own))
    ordered = F.array_sort(F.collect_list(F.struct("part_start", tail.alias("tail"), "record")))
    together = fragments.groupBy("path", "file_name", "number").agg(
        F.max("is_first").alias("is_first"),
        F.array_join(F.transform(ordered, lambda part: part["record"]), "").alias("record"),
    )
    return whole.unionByName(together.select("file_name", "is_first", "record"))
