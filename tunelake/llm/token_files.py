"""Token-id files with keyed access: raw ids in shards, found through a minimal perfect hash of the keys.

A shard is one file: a header, the ids of its documents one after the other (little-endian, 16 bits where the
vocabulary allows, else 32), and an index. The index is a minimal perfect hash: keys fall into buckets, and each
bucket has a displacement that sends its keys to slots of their own among exactly as many slots as there are keys.
A slot holds a fingerprint of its key, the first id and the number of ids, so that a look-up reads one bucket and
one slot, and a key that is not there is refused by its fingerprint (but for one in 2**32).

A key is a document id with the number of its occurrence, so repeated ids are all kept. Documents are written in
ascending order of their ids (null first; equal ids in the order of their texts) by a range partitioning, and each
task writes its shards under a name of its own, so a task that runs again leaves the earlier files unused. The
manifest of shards, one line each, is what counts as written.

Rules: a null text is an empty one; every document ends with the end id, so an empty one has this id alone. Extra
columns are not read. An empty table gives no shards. Very long texts are encoded whole, in pieces between which
the tokenizer never joins.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunelake.llm.common import Rows, SpanPlaces, distinct, mixed, text_chunks, work_folder, worker_state, written

MAGIC = b"TLIDS001"
END_ID = 0
#: A shard is closed when it has so many ids or documents; its index is built in memory.
SHARD_IDS = 32_000_000
SHARD_DOCS = 200_000
KEYS_PER_BUCKET = 4
_SLOT = np.dtype([("fingerprint", "<u4"), ("start", "<u8"), ("count", "<u8")])
_NO_ID = -(2**63)


# --- the minimal perfect hash -------------------------------------------------------------------------

def key_hashes(ids: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    """64-bit hashes of the keys."""
    return mixed(mixed(ids.astype(np.int64).view(np.uint64)) ^ occurrences.astype(np.uint64))


def _slots(hashes: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        moved = mixed(hashes ^ (displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return (moved % np.uint64(size)).astype(np.int64)


def _buckets(hashes: np.ndarray, size: int) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(max(1, size // KEYS_PER_BUCKET))).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """A displacement for every bucket, the fullest buckets first. Two equal hashes have no perfect hash."""
    size = len(hashes)
    if len(np.unique(hashes)) < size:
        raise ValueError("two keys have the same hash")
    buckets = _buckets(hashes, size)
    displacement = np.zeros(max(1, size // KEYS_PER_BUCKET), np.uint32)
    order = np.argsort(buckets, kind="stable")
    bounds = np.searchsorted(buckets[order], np.arange(len(displacement) + 1))
    counts = np.diff(bounds)
    taken = np.zeros(size, bool)
    for bucket in np.argsort(-counts, kind="stable"):
        count = counts[bucket]
        if not count:
            break
        own = hashes[order[bounds[bucket]:bounds[bucket + 1]]]
        first, tries = 0, 16
        while True:  # all displacements of a range at once
            asked = np.arange(first, first + tries, dtype=np.uint64)
            slots = _slots(own[None, :], asked[:, None], size)
            free = ~taken[slots].any(axis=1)
            if count > 1 and free.any():
                ordered = np.sort(slots, axis=1)
                free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if free.any():
                chosen = int(free.argmax())
                displacement[bucket] = first + chosen
                taken[slots[chosen]] = True
                break
            first, tries = first + tries, min(65_536, tries * 4)
    return displacement


class Shard:
    """An open shard: ``ids(doc_id, occurrence)`` in constant time."""

    def __init__(self, path: str):
        files, name = fs.FileSystem.from_uri(path)
        with files.open_input_file(name) as source:
            magic, width, docs, ids = struct.unpack("<8sQQQ", source.read(32))
            if magic != MAGIC:
                raise ValueError(f"{path} is not a token file")
            self.type = np.dtype("<u2" if width == 2 else "<u4")
            self.payload = np.frombuffer(source.read(ids * width), self.type)
            self.displacement = np.frombuffer(source.read(4 * max(1, docs // KEYS_PER_BUCKET)), "<u4")
            self.slots = np.frombuffer(source.read(_SLOT.itemsize * docs), _SLOT)

    def places(self, ids: np.ndarray, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of each key; -1 where the shard does not hold it."""
        if not len(self.slots):
            return np.full(len(ids), -1), np.full(len(ids), -1)
        hashes = key_hashes(ids, occurrences)
        slots = self.slots[_slots(hashes, self.displacement[_buckets(hashes, len(self.slots))], len(self.slots))]
        right = slots["fingerprint"] == (hashes >> np.uint64(32)).astype(np.uint32)
        return np.where(right, slots["start"].astype(np.int64), -1), np.where(right, slots["count"].astype(np.int64), -1)

    def ids(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        start, count = self.places(np.array([_NO_ID if doc_id is None else doc_id]), np.array([occurrence]))
        return None if start[0] < 0 else self.payload[start[0]:start[0] + count[0]]


class KeyedFile:
    """A shard that stays closed: a look-up reads its header, one displacement, one slot and the ids asked for."""

    def __init__(self, path: str):
        self.files, self.name = fs.FileSystem.from_uri(path)
        self.bytes_read = 0

    def _read(self, source, at: int, size: int) -> bytes:
        self.bytes_read += size
        return source.read_at(size, at)

    def ids(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a key, None where the shard does not hold it."""
        with self.files.open_input_file(self.name) as source:
            magic, width, docs, ids = struct.unpack("<8sQQQ", self._read(source, 0, 32))
            if magic != MAGIC:
                raise ValueError(f"{self.name} is not a token file")
            if not docs:
                return None
            hashes = key_hashes(np.array([_NO_ID if doc_id is None else doc_id]), np.array([occurrence]))
            index = 32 + ids * width
            moved = np.frombuffer(self._read(source, index + 4 * int(_buckets(hashes, docs)[0]), 4), "<u4")
            slots = index + 4 * max(1, docs // KEYS_PER_BUCKET)
            at = slots + _SLOT.itemsize * int(_slots(hashes, moved, docs)[0])
            slot = np.frombuffer(self._read(source, at, _SLOT.itemsize), _SLOT)[0]
            if slot["fingerprint"] != np.uint32(hashes[0] >> np.uint64(32)):
                return None
            found = self._read(source, 32 + int(slot["start"]) * width, int(slot["count"]) * width)
            return np.frombuffer(found, "<u2" if width == 2 else "<u4")


class _Writer:
    """Gathers documents and writes them as shards below a folder."""

    def __init__(self, folder: str, width: int):
        self.folder, self.type = folder, np.dtype("<u2" if width == 2 else "<u4")
        self.parts: list[np.ndarray] = []
        self.keys: list[tuple[int, int]] = []
        self.total = 0

    def add(self, doc_id: int, occurrence: int, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.type))
        self.keys.append((doc_id, occurrence))
        self.total += len(ids)

    def full(self) -> bool:
        return self.total >= SHARD_IDS or len(self.keys) >= SHARD_DOCS

    def close(self) -> tuple[str, int]:
        """Writes the shard; its path and number of ids."""
        keys = np.array(self.keys, np.int64)
        hashes = key_hashes(keys[:, 0], keys[:, 1])
        displacement = perfect_hash(hashes)
        counts = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        slots = np.zeros(len(keys), _SLOT)
        at = _slots(hashes, displacement[_buckets(hashes, len(keys))], len(keys))
        slots["fingerprint"][at] = (hashes >> np.uint64(32)).astype(np.uint32)
        slots["start"][at] = np.cumsum(counts) - counts
        slots["count"][at] = counts
        path = f"{self.folder}/{uuid.uuid4().hex}.ids"
        files, name = fs.FileSystem.from_uri(path)
        files.create_dir(name.rpartition("/")[0], recursive=True)
        with files.open_output_stream(name) as out:
            out.write(struct.pack("<8sQQQ", MAGIC, self.type.itemsize, len(keys), self.total))
            for part in self.parts:
                out.write(part.tobytes())
            out.write(displacement.astype("<u4").tobytes())
            out.write(slots.tobytes())
        total, self.parts, self.keys, self.total = self.total, [], [], 0
        return path, total


# --- encoding -------------------------------------------------------------------------------------------

#: Bytes of ASCII white space, and others that some call so.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
#: The UTF-8 bytes of white space beyond ASCII.
_WIDE_WHITE = [chr(code).encode() for code in (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)]
_NO_SPACE_INSIDE = re.compile(r" ?\S+")
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?")] = True
#: What goes to the library's model as it is: a run of one kind, with or without the space before it, or a line feed.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f" ?(?:[{_LETTERS}]++|[0-9]++|[.,;:!?]++)|\n")
_JOINED = 64


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte if byte in shown else 256 + hidden.index(byte)) for byte in range(256)}


class _Pieces:
    """Ids by place, one piece after the other; those behind the kept ones are written over by the next."""

    def __init__(self):
        self.ids, self.bounds = Rows(1, np.uint32), Rows(2, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray, keep: bool) -> int:
        first = self.ids.add(ids[:, None], keep)
        ends = first + np.cumsum(sizes)
        return self.bounds.add(np.column_stack([ends - sizes, ends]), keep)

    def joined(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``places`` one after the other, and how many each has."""
        bounds = self.bounds.held[places]
        counts = bounds[:, 1] - bounds[:, 0]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids.held[np.arange(total) + np.repeat(bounds[:, 0] - (ends - counts), counts), 0], counts


class Encoder:
    """Encodes whole texts with a byte-level tokenizer, remembering the pieces it has met.

    Such a tokenizer first cuts a text, and at some places always. The text is cut there, each different piece (told apart by 128 bits of hashes) is encoded by the
    library once, and the ids are put together again. Pieces of one kind of characters go to the library's model as
    they are, others through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        settings = json.loads(open(path, encoding="utf-8").read())
        self.tokenizer = Tokenizer.from_file(path)
        cutter = settings.get("pre_tokenizer") or {}
        self.cuts = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and (
            cutter.get("use_regex", True) and not settings.get("normalizer")
        ) and not any(token["lstrip"] or token["rstrip"] or " " in token["content"] for token in settings["added_tokens"])
        # Tokens of their own are found anywhere in a text: none may hold a cut, or stand in a plain piece.
        own = [token["content"] for token in settings["added_tokens"]]
        self.plain = self.cuts and not any(
            set(content) & set(".,;:!?\n") or re.fullmatch(f"[{_LETTERS}0-9]*", content) for content in own
        )
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        #: The pieces met: those behind a space with it, those that begin a text without.
        self.known, self.pieces = SpanPlaces(), _Pieces()
        self.characters = _byte_characters()
        feed = self._ids(["\n"])[0]
        self.feed = feed[0] if self.cuts and len(feed) == 1 else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and how many each has."""
        ids: list[list[int]] = [[]] * len(pieces)
        plain = [place for place, piece in enumerate(pieces) if _PLAIN.fullmatch(piece)] if self.plain else []
        if plain:  # a zero byte stands in no plain piece
            shown = "\0".join([pieces[place] for place in plain]).encode().decode("latin-1").translate(self.characters)
            tokenize = self.tokenizer.model.tokenize
            for place, piece in zip(plain, shown.split(self.characters[0]), strict=True):
                ids[place] = [token.id for token in tokenize(piece)]
        modelled = set(plain)
        self._other(pieces, [place for place in range(len(pieces)) if place not in modelled], ids)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _other(self, pieces: list[str], places: list[int], ids: list[list[int]]) -> None:
        """Encodes pieces by the whole tokenizer.

        Those without white space inside go many at a time with line feeds between them, which are cut off as tokens
        of their own and stand nowhere else.
        """
        spaced = [place for place in places if not _NO_SPACE_INSIDE.fullmatch(pieces[place])]
        joined = [place for place in places if _NO_SPACE_INSIDE.fullmatch(pieces[place])] if self.feed is not None else []
        spaced = spaced if joined else places
        for begin in range(0, len(joined), _JOINED):
            part = joined[begin:begin + _JOINED]
            found = np.array(self._ids(["\n".join(pieces[place] for place in part)])[0], np.uint32)
            feeds = np.flatnonzero(found == self.feed)
            if len(feeds) != len(part) - 1:
                spaced = [*spaced, *part]
                continue
            for place, first, behind in zip(part, [0, *(feeds + 1)], [*feeds, len(found)], strict=True):
                ids[place] = found[first:behind].tolist()
        for begin in range(0, len(spaced), _JOINED):
            part = spaced[begin:begin + _JOINED]
            for place, own in zip(part, self._ids([pieces[place] for place in part]), strict=True):
                ids[place] = own

    def _cuts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where pieces start in texts that stand one after the other: at each text, and where the tokenizer always cuts.

        That is before a single space, and on both sides of a single line feed, between two characters that are no
        white space; and between a Latin letter and a mark of ``.,;:!?`` on either side.
        """
        if not self.cuts:
            return begins
        inside = np.ones(len(data) + 1, bool)
        inside[begins] = False  # nor may a text end behind the space
        single = np.flatnonzero((data == 32) | (data == 10))
        single = single[(single > 0) & (single < len(data) - 1)]
        before, behind = data[single - 1], data[single + 1 if len(single) else single]
        safe = inside[single] & inside[single + 1] & ~_WHITE[before] & ~_WHITE[behind]
        wide = np.flatnonzero(safe & ((before >= 128) | (behind >= 0xC2)))
        for white in _WIDE_WHITE if len(wide) else ():
            size = len(white)
            for first in (single[wide] - size, single[wide] + 1):
                fits = (first >= 0) & (first + size <= len(data))
                at, equal = np.where(fits, first, 0), fits
                for place, byte in enumerate(white):
                    equal = equal & (data[np.minimum(at + place, len(data) - 1)] == byte)
                safe[wide[equal]] = False
        cuts = [begins, single[safe], single[safe & (data[single] == 10)] + 1]
        if self.plain:
            mark = _MARK[data]
            # Before a mark stands an ASCII letter, or the last byte of a letter from U+00C0 to U+024F.
            edge = np.flatnonzero(mark[1:] & ~mark[:-1]) + 1
            last, lead = data[edge - 1], data[np.maximum(edge - 2, 0)]
            wide_letter = (last & 0xC0 == 0x80) & (
                (lead == 0xC3) & (last != 0x97) & (last != 0xB7) | (lead >= 0xC4) & (lead <= 0xC8)
                | (lead == 0xC9) & (last <= 0x8F)
            )
            cuts += [edge[_LETTER[last] | wide_letter], np.flatnonzero(mark[:-1] & _LETTER[data[1:]]) + 1]
        return distinct(np.concatenate(cuts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        encoded = [text.encode() for text in texts]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(encoded), np.uint8)
        if not len(data):
            return [np.empty(0, np.uint32)] * len(texts)
        starts = self._cuts(data, offsets[:-1][sizes > 0])
        ends = np.append(starts[1:], len(data))

        def add(pieces: list[bytes], keep: bool) -> int:
            return self.pieces.add(*self._encoded([piece.decode() for piece in pieces]), keep)

        places = self.known.of(data, starts, ends, add)
        ids, counts = self.pieces.joined(places)
        bounds = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        return [ids[bounds[k]:bounds[k + 1]] for k in range(len(texts))]


def _encoder(path: str) -> Encoder:
    return worker_state(f"encoder {path}", lambda: Encoder(path))


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs (doc_id, text)`` and returns the index of what was written, computed once.

    One row per document: ``shard`` (path), ``part, shard_number`` (the order of the shards), ``doc_id``,
    ``occurrence``, and on the first row of each shard ``shard_ids`` (its number of ids, else 0).
    """
    folder = folder or work_folder(docs.sparkSession, "token-files")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    ).withColumn("part", F.spark_partition_id().cast("long"))

    def encoded(batches):
        encoder = _encoder(tokenizer_path)
        writer = _Writer(folder, encoder.width)
        number, last, occurrence = 0, None, -1
        part = 0

        def closed():
            keys = list(writer.keys)
            path, total = writer.close()
            return pd.DataFrame({
                "shard": path, "part": part, "shard_number": number,
                "doc_id": pd.array([None if k == _NO_ID else k for k, _ in keys], "Int64"),
                "occurrence": [o for _, o in keys], "shard_ids": [total] + [0] * (len(keys) - 1),
            })

        for batch in batches:
            rows = zip(batch["doc_id"], batch["part"], strict=True)
            for texts in text_chunks(batch["text"].tolist()):
                for ids in encoder.encode(texts):
                    doc_id, part = next(rows)
                    key = _NO_ID if pd.isna(doc_id) else int(doc_id)
                    occurrence = occurrence + 1 if key == last else 0
                    last = key
                    writer.add(key, occurrence, np.append(ids, np.uint32(end_id)))
                    if writer.full():
                        yield closed()
                        number += 1
        if writer.keys:
            yield closed()

    return written(ordered.mapInPandas(
        encoded, "shard string, part long, shard_number long, doc_id long, occurrence long, shard_ids long"
    ), "token-index")


def read(index: DataFrame) -> DataFrame:
    """Reads every document back by its key: ``doc_id, occurrence, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is of the ids as little-endian 32-bit values.
    """
    # One line per shard: the ids of all shards before it.
    shards = index.where("shard_ids > 0").select("shard", "part", "shard_number", "shard_ids")
    before = Window.orderBy("part", "shard_number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("shard_start"))

    def looked_up(batches):
        path, shard = None, None
        for batch in batches:
            for name, own in batch.groupby("shard", sort=False):
                if name != path:
                    path, shard = name, Shard(name)
                keys = own["doc_id"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
                starts, counts = shard.places(keys, own["occurrence"].to_numpy(np.int64))
                if (starts < 0).any():
                    raise ValueError(f"{name} does not hold all of its keys")
                yield pd.DataFrame({
                    "shard": name, "doc_id": own["doc_id"].astype("Int64"), "occurrence": own["occurrence"],
                    "at": starts, "n_tokens": counts,
                    "ids_crc32": [
                        zlib.crc32(shard.payload[a:a + n].astype("<u4").tobytes())
                        for a, n in zip(starts.tolist(), counts.tolist(), strict=True)
                    ],
                })

    found = index.select("shard", "doc_id", "occurrence").mapInPandas(
        looked_up, "shard string, doc_id long, occurrence long, at long, n_tokens long, ids_crc32 long"
    )
    return found.join(offsets, "shard").select(
        "doc_id", "occurrence", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
