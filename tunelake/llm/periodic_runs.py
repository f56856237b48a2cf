"""Periodic runs of words, found with a dictionary of basic factors, and texts with their repeats taken out.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are equal), of at least ``LEAST_WORDS``
words and ``LEAST_PERIODS`` periods, that no neighbouring word goes on. The dictionary names, for every power of
two ``L``, the factors of ``L`` words that occur twice in a text; the names for ``2 L`` are those of pairs of names
for ``L``, so only places whose halves both occur twice are looked at again, and plain text leaves the dictionary
after a few lengths.

An occurrence proposes the distance ``d`` to its successor as a period when both lie within ``2 L`` words
(``d <= L``). Successive starts with one such ``d`` are one stretch: from the first start to the last one, and
``L + d`` words more. It cannot be extended: a word more on either side with the same period would be one more
start with the same ``d``, as two distances up to ``L`` at overlapping places share a divisor that would be the
distance itself. For the same reason ``d`` is the smallest period of the stretch. A run of period ``q`` is proposed
for every ``L`` from ``q`` to its length less ``q``, at least once, as it has three periods; equal proposals are
merged.

A task looks at the texts of a batch together; words of different texts have different names, so no factor that
reaches over the end of a text occurs twice. No row is shuffled.

Rules: a null or empty text has no words and no runs. Rows without id are read like all others, as are repeated
rows and ids. Of runs with equal ``length / period`` the one that starts first, then the smaller period, is the
longest. Very long texts are read whole. Other columns stay as they are, but for those named like a result. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Texts are looked at together up to about so many words.
CHUNK_WORDS = 1 << 19

#: Start, length and period of each run, by start, then period.
Runs = np.ndarray
#: Picks the words of a text, by their numbers, that are read in place of the words as they stand.
Order = Callable[[object, int], np.ndarray | None]

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
])


def words(text: str | None) -> list[bytes]:
    """The runs of a text without ASCII white space, as UTF-8."""
    return text.encode("utf-8", "replace").split() if text else []


# --- the dictionary of basic factors ------------------------------------------------------------------

def _by_name(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and ascending places, sorted by name, then place."""
    if not len(names):
        return names, places
    bits = int(places[-1]).bit_length()
    if int(names.max()).bit_length() + bits <= 63:
        both = np.sort((names << bits) | places)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(names, kind="stable")
    return names[order], places[order]


def _proposals(places: np.ndarray, distances: np.ndarray, length: int) -> np.ndarray:
    """Stretches of successive starts with one distance: start, length and period, those that are long enough."""
    if not len(places):
        return np.empty((0, 3), np.int64)
    order = np.argsort(places)
    places, distances = places[order], distances[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(distances) != 0)]))
    last = np.append(first[1:], len(places)) - 1
    period = distances[first]
    size = places[last] - places[first] + length + period
    enough = size >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return np.column_stack([places[first], size, period])[enough]


def runs_of(names: np.ndarray) -> Runs:
    """The runs of a sequence of names (whole numbers from 0)."""
    found, total, length = [], len(names), 1
    places, names = np.arange(total), names.astype(np.int64)
    name_at = np.empty(total, np.int64)
    while len(places):
        names, places = _by_name(names, places)
        again = names[1:] == names[:-1]  # the next occurrence of the same factor stands behind
        distance = places[1:] - places[:-1]
        near = again & (distance <= length)
        found.append(_proposals(places[:-1][near], distance[near], length))
        twice = np.zeros(len(places), bool)
        twice[1:] |= again
        twice[:-1] |= again
        dense = np.cumsum(np.concatenate([[0], ~again]))[:len(places)]
        places, dense = places[twice], dense[twice]
        if not len(places):
            break
        order = np.argsort(places)
        places, dense = places[order], dense[order]
        dense = np.unique(dense, return_inverse=True)[1]
        name_at.fill(-1)
        name_at[places] = dense
        inside = places + length < total
        places, dense = places[inside], dense[inside]
        behind = name_at[places + length]
        places, names = places[behind >= 0], (dense * (len(name_at) + 1) + behind)[behind >= 0]
        length *= 2
        if total < length or not len(places):
            break
        if total > 1 << 31:  # pairs of names must stay within 64 bits
            raise ValueError("too many words at once")
        names = np.unique(names, return_inverse=True)[1]
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = np.unique(runs, axis=0) if len(runs) else runs
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# --- texts ----------------------------------------------------------------------------------------------

def best_run(runs: Runs) -> tuple[int, int, int] | None:
    """The run with most periods; of equal ones the first, then the one with the smaller period."""
    if not len(runs):
        return None
    start, length, period = max(runs.tolist(), key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]))
    return start, length, period


def kept_words(count: int, runs: Runs) -> np.ndarray:
    """Which of ``count`` words stay: those that no run contains behind its first period."""
    depth = np.zeros(count + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:count] == 0


def batch_runs(texts: list[list[bytes]]) -> list[Runs]:
    """The runs of each text, given as its words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum())
    if not total:
        return [np.empty((0, 3), np.int64)] * len(texts)
    codes, different = pd.factorize(np.fromiter((word for own in texts for word in own), object, total))
    owner = np.repeat(np.arange(len(texts)), sizes)
    runs = runs_of(codes.astype(np.int64) + owner * len(different))
    begins = np.cumsum(sizes) - sizes
    of = owner[runs[:, 0]]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    return [
        runs[bounds[k]:bounds[k + 1]] - np.array([begins[k], 0, 0]) for k in range(len(texts))
    ]


def _chunks(rows: pd.DataFrame, order: Order | None) -> Iterator[list[list[bytes]]]:
    """The words of the rows' texts, some rows at a time."""
    part, held = [], 0
    for key, text in zip(rows["key"], rows["text"], strict=True):
        own = words(text)
        numbers = order(key, len(own)) if order and own else None
        if numbers is not None:
            own = [own[i] for i in numbers.tolist()]
        part.append(own)
        held += len(own)
        if held >= CHUNK_WORDS:
            yield part
            part, held = [], 0
    if part:
        yield part


def _digest(rows: list[list[int]], own: list[bytes], runs: Runs) -> dict:
    best = best_run(runs)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in rows)
    kept = own if not rows else [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
    start, length, period = best or (None, None, None)
    return {
        "n_runs": len(rows), "start": start, "length": length, "period": period,
        "exponent_milli": best and 1000 * length // period,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
    }


_DIGEST = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def _with(docs: DataFrame, order: Order | None, key: str | None, schema: str | T.StructType, row) -> DataFrame:
    """``docs`` with a struct ``runs_found`` made by ``row(words, runs)`` of each text."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.fieldNames()
    whole = [name for name in names if isinstance(fields[name].dataType, T.LongType)]

    @F.pandas_udf(fields)
    def found(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in _chunks(pd.DataFrame({"key": keys, "text": texts}), order):
            rows += [row(own, runs) for own, runs in zip(part, batch_runs(part), strict=True)]
        return pd.DataFrame(rows, columns=names).astype({name: "Int64" for name in whole})

    kept = [name for name in docs.columns if name not in names]
    asked = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return docs.select(*kept, found(asked, F.col("text").cast("string")).alias("runs_found")).select(
        *kept, *(F.col("runs_found")[name].alias(name) for name in names)
    )


def runs_and_text(docs: DataFrame, order: Order | None = None, key: str | None = None) -> DataFrame:
    """``docs`` with ``n_words``, the ``runs`` of ``text`` and ``collapsed``, its words without the repeats.

    ``order`` may give, for the column ``key`` as text and a number of words, the numbers of the words to read.
    """
    def row(own: list[bytes], runs: Runs) -> dict:
        kept = [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
        return {
            "n_words": len(own), "runs": [dict(zip(RUN.fieldNames(), run, strict=True)) for run in runs.tolist()],
            "collapsed": b" ".join(kept).decode("utf-8", "replace"),
        }

    return _with(docs, order, key, RESULT, row)


def run_digests(docs: DataFrame, order: Order | None = None, key: str | None = None) -> DataFrame:
    """``docs`` with the number of runs, the one with most periods, and digests of all runs and of the text left."""
    return _with(docs, order, key, _DIGEST, lambda own, runs: _digest(runs.tolist(), own, runs))
