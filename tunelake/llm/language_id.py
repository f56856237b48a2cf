"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a run of text without ASCII white space in both directions and gives every byte a
probability for each language. A run of more than ``RUN_BYTES`` bytes is read in windows cut between characters,
each with ``MARGIN_BYTES`` more bytes on both sides that are read, but counted in the window they belong to. A
document's probabilities are the mean over its letter bytes (ASCII letters and all bytes of other characters); its
language is the most probable one. ``labelled_spans`` returns the labels of the positions themselves. Equal runs get
equal labels, so a worker reads each different run once and looks short ones up afterwards, in a memory bounded by
bytes; texts are read some at a time, whatever the size of a batch.

Training is backpropagation through time in numpy with Adam, on a sample bounded by ``Training.docs`` documents of
each of the ``Training.languages`` most frequent languages and ``Training.windows`` windows of each document, spread
over its text. Documents are chosen by hashes of their ids: a threshold from the number of ids leaves about twice
as many as needed of each language, and these alone are ranked. Rarer languages than that are never predicted. Every
document is scored over its whole text.

Rules: a text that is null or has no letter is ``und`` with score 0; empty texts too. Without any row to learn
from, every document is ``und``. Equal probabilities go to the language that is first by code point. Rows without
id are scored, but not learnt from; repeated rows are scored alike, and a repeated id is learnt once for a language.
Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import Rows, SpanPlaces, pieces_of, text_chunks, training_row, worker_state

UNKNOWN = "und"
RUN_BYTES = 32
MARGIN_BYTES = 8

_LETTER = re.compile(r"[^\W\d_]")
_PIECE = re.compile(r"[^ \t-\r]+")
#: Bytes of a run, and the first and the place behind the last that count.
Part = tuple[bytes, int, int]
_LETTER_BYTE = np.array([value >= 128 or chr(value).isalpha() for value in range(256)])


@dataclass(frozen=True)
class Training:
    """The bounds of the sample, and the network's size and steps."""

    docs: int = 400
    windows: int = 64
    languages: int = 256
    hidden: int = 12
    steps: int = 300
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class _Direction:
    """Gated recurrent units read in one direction. ``x``: input weights by byte; ``u``: recurrent weights."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        scale = 1.0 / np.sqrt(hidden)
        self.x = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((hidden, 3 * hidden)) * scale).astype(np.float32)
        self.hidden = hidden

    def forward(self, data: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte (time, run, hidden); bytes beyond a run's end leave its state as it is."""
        n = self.hidden
        state = np.zeros((data.shape[1], n), np.float32)
        states = np.empty((*data.shape, n), np.float32)
        for t in range(len(data)):
            given = self.x[data[t]]
            gates = _sigmoid(given[:, :2 * n] + state @ self.u[:, :2 * n])
            reset, update = gates[:, :n], gates[:, n:]
            new = np.tanh(given[:, 2 * n:] + (reset * state) @ self.u[:, 2 * n:])
            if keep is not None:
                keep.append((state, reset, update, new))
            state = np.where(mask[t][:, None], state + update * (new - state), state)
            states[t] = state
        return states

    def backward(self, data, mask, keep, d_states) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``x`` and ``u`` from those of the states, back through time."""
        n = self.hidden
        d_x, d_u = np.zeros_like(self.x), np.zeros_like(self.u)
        d_next = np.zeros_like(d_states[0])
        for t in range(len(data) - 1, -1, -1):
            state, reset, update, new = keep[t]
            inside = mask[t][:, None]
            d_state = (d_states[t] + d_next)
            d_here = np.where(inside, d_state, 0.0)
            d_new = d_here * update * (1.0 - new * new)
            d_mixed = d_new @ self.u[:, 2 * n:].T
            d_update = d_here * (new - state) * update * (1.0 - update)
            d_reset = d_mixed * state * reset * (1.0 - reset)
            d_gates = np.concatenate([d_reset, d_update], axis=1)
            d_u[:, :2 * n] += state.T @ d_gates
            d_u[:, 2 * n:] += (reset * state).T @ d_new
            np.add.at(d_x, data[t], np.concatenate([d_gates, d_new], axis=1))
            d_next = np.where(
                inside, d_here * (1.0 - update) + d_mixed * reset + d_gates @ self.u[:, :2 * n].T, d_state
            )
        return d_x, d_u


class Network:
    """Both directions and a softmax over the languages for each byte."""

    def __init__(self, languages: list[str], training: Training = Training()):
        rng = np.random.default_rng(training.seed)
        self.languages, self.training = languages, training
        self.ahead, self.back = _Direction(rng, training.hidden), _Direction(rng, training.hidden)
        self.out = (rng.standard_normal((2 * training.hidden, len(languages))) * 0.1).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.back.x, self.back.u, self.out, self.bias]

    @staticmethod
    def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes by (time, run), and where they are."""
        longest = max(map(len, runs))
        data = np.frombuffer(b"".join(run.ljust(longest, b"\0") for run in runs), np.uint8)
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        return data.reshape(len(runs), longest).T.copy(), np.arange(longest)[:, None] < sizes[None, :]

    def probabilities(self, data, mask, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (time, run, language) and the states they come from."""
        ahead = self.ahead.forward(data, mask, keep and keep[0])
        back = self.back.forward(data[::-1], mask[::-1], keep and keep[1])[::-1]
        states = np.concatenate([ahead, back], axis=2)
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True), states

    def gradients(self, runs: list[bytes], truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all letter bytes, and its gradients."""
        data, mask = self.padded(runs)
        keep: tuple[list, list] = ([], [])
        given, states = self.probabilities(data, mask, keep)
        counted = mask & _LETTER_BYTE[data]
        total = max(1, counted.sum())
        runs_at = np.arange(data.shape[1])
        loss = -np.log(given[:, runs_at, truth] + 1e-9)[counted].sum() / total
        d_scores = given.copy()
        d_scores[:, runs_at, truth] -= 1.0
        d_scores *= counted[:, :, None] / np.float32(total)
        flat = d_scores.reshape(-1, d_scores.shape[2])
        d_out = states.reshape(-1, states.shape[2]).T @ flat
        d_states = d_scores @ self.out.T
        n = self.ahead.hidden
        ahead = self.ahead.backward(data, mask, keep[0], d_states[:, :, :n])
        back = self.back.backward(data[::-1], mask[::-1], keep[1], d_states[::-1, :, n:])
        return float(loss), [*ahead, *back, d_out, flat.sum(axis=0)]

    def fit(self, runs: list[bytes], truth: np.ndarray) -> Network:
        """Adam over batches in which every language has the same weight, for a fixed number of steps."""
        plan = self.training
        rng = np.random.default_rng(plan.seed + 1)
        places = [np.nonzero(truth == k)[0] for k in range(len(self.languages))]
        each = max(1, plan.batch // len(places))
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        for step in range(1, plan.steps + 1):
            chosen = np.concatenate([rng.choice(own, each) for own in places])
            _, slopes = self.gradients([runs[i] for i in chosen], truth[chosen])
            rate = plan.rate * min(1.0, 2.0 * (1.0 - step / (plan.steps + 1)))
            for weight, slope, m, v in zip(self.weights, slopes, first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                weight -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def _read(self, windows: list[Part]):
        """Windows of like sizes together: their places, bytes, which of them count, and probabilities."""
        order = sorted(range(len(windows)), key=lambda i: len(windows[i][0]))
        for begin in range(0, len(order), 2048):
            part = order[begin:begin + 2048]
            data, mask = self.padded([windows[i][0] for i in part])
            first, behind = np.array([windows[i][1:] for i in part]).T
            at = np.arange(len(data))[:, None]
            given, _ = self.probabilities(data, mask)
            yield part, data, (at >= first) & (at < behind), given

    def letter_sums(self, windows: list[Part]) -> np.ndarray:
        """For each window the sum of its letter bytes' probabilities, and behind these their number."""
        sums = np.zeros((len(windows), len(self.languages) + 1), np.float32)
        for part, data, counted, given in self._read(windows):
            counted = counted & _LETTER_BYTE[data]
            sums[part, :-1] = (given * counted[:, :, None]).sum(axis=0)
            sums[part, -1] = counted.sum(axis=0)
        return sums

    def byte_labels(self, windows: list[Part]) -> list[np.ndarray]:
        """For each window the most probable language of its own bytes, -1 where a byte is no letter."""
        labels: list = [None] * len(windows)
        for part, data, counted, given in self._read(windows):
            best = np.where(_LETTER_BYTE[data], given.argmax(axis=2), -1)
            for column, place in enumerate(part):
                labels[place] = best[counted[:, column], column]
        return labels


def _border(data: bytes, at: int) -> int:
    """The first place from ``at`` backwards where a character begins."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def byte_runs(data: bytes) -> list[Part]:
    """A run of text in windows ``(bytes, first, behind)``; the bytes from first to behind are a window's own."""
    if len(data) <= RUN_BYTES:
        return [(data, 0, len(data))] if data else []
    parts = -(-len(data) // RUN_BYTES)
    cuts = sorted({_border(data, len(data) * k // parts) for k in range(parts + 1)})
    found = []
    for first, behind in zip(cuts, cuts[1:]):
        begin = _border(data, max(0, first - MARGIN_BYTES))
        end = _border(data, min(len(data), behind + MARGIN_BYTES))
        found.append((data[begin:end], first - begin, behind - begin))
    return found


class Identifier:
    """Scores texts with a trained network, remembering short runs as far as ``SpanPlaces`` has room for them."""

    def __init__(self, network: Network):
        self.network = network
        self.known = SpanPlaces()
        self.sums = Rows(len(network.languages) + 1)

    def _read(self, pieces: list[bytes]) -> np.ndarray:
        """Reads pieces once each; a long piece has the sum of its windows."""
        added = np.zeros((len(pieces), len(self.network.languages) + 1), np.float32)
        for begin in range(0, len(pieces), 65_536):
            parts = [byte_runs(piece) for piece in pieces[begin:begin + 65_536]]
            sums = self.network.letter_sums([window for own in parts for window in own])
            np.add.at(added, begin + np.repeat(np.arange(len(parts)), [len(own) for own in parts]), sums)
        return added

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for part in text_chunks(texts):
            data, starts, ends, bounds = pieces_of(part)
            at = self.known.of(data, starts, ends, lambda pieces, keep: self.sums.add(self._read(pieces), keep))
            totals = np.concatenate([np.zeros((1, self.sums.held.shape[1])), np.cumsum(self.sums.held[at], axis=0, dtype=np.float64)])
            for text, total in zip(part, totals[bounds[1:]] - totals[bounds[:-1]], strict=True):
                if not text or not _LETTER.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = total[:-1] / max(1.0, total[-1])
                best = int(mean.argmax())
                names.append(self.network.languages[best])
                scores.append(float(min(1.0, max(0.0, mean[best]))))
        return names, scores

    def labels(self, text: str) -> np.ndarray:
        """The label of every character, that of its first byte; -1 for white space and what is no letter."""
        found = np.full(len(text), -1, np.int64)
        pieces = list(_PIECE.finditer(text))
        windows = [byte_runs(piece.group().encode("utf-8", "replace")) for piece in pieces]
        labelled = iter(self.network.byte_labels([window for own in windows for window in own]))
        for piece, own in zip(pieces, windows, strict=True):
            data = np.frombuffer(b"".join(window[first:behind] for window, first, behind in own), np.uint8)
            by_byte = np.concatenate([next(labelled) for _ in own])
            found[piece.start():piece.end()] = by_byte[(data & 0xC0) != 0x80]
        return found

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """``language, first, behind`` of the longest stretches of one label; what has no label parts none."""
        labels = self.labels(text) if text else np.empty(0, np.int64)
        at = np.flatnonzero(labels >= 0)
        if not len(at):
            return []
        first = np.flatnonzero(np.concatenate([[True], np.diff(labels[at]) != 0]))
        last = np.append(first[1:], len(at)) - 1
        return [
            (self.network.languages[labels[at[i]]], int(at[i]), int(at[j]) + 1) for i, j in zip(first, last, strict=True)
        ]


def learnt_sample(docs: DataFrame, rule: F.Column, training: Training = Training()) -> list[tuple[str, list[bytes]]]:
    """``language, windows`` of the documents learnt from, a bounded number for each language."""
    lang = F.col("lang").cast("string").alias("lang")
    labelled = docs.where(rule & F.col("lang").isNotNull()).select(lang, "doc_id", F.xxhash64("doc_id").alias("place"))
    frequent = labelled.groupBy("lang").agg(
        F.count("*").alias("count"), F.approx_count_distinct("doc_id", 0.02).alias("ids")
    ).orderBy(F.desc("count"), "lang").limit(training.languages)
    # A line per language, of which there are ``Training.languages`` at most.
    share = F.least(F.lit(1.0), F.lit(2.0 * training.docs + 100) / F.greatest("ids", F.lit(1)))
    few = labelled.join(F.broadcast(frequent), "lang").where(
        F.pmod("place", F.lit(1 << 32)) < share * float(1 << 32)
    ).groupBy("lang", "doc_id", "place").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= training.docs)

    def spread(batches):
        for batch in batches:
            rows = []
            for doc_id, name, text in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True):
                pieces = _PIECE.findall(text or "")
                windows = [w[0] for p in pieces if _LETTER.search(p) for w in byte_runs(p.encode("utf-8", "replace"))]
                step = max(1, len(windows) // training.windows)
                if windows:
                    rows.append((doc_id, name, windows[step // 2::step][:training.windows]))
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "windows"])

    # At most ``languages * docs`` ids are broadcast, and as many short lists collected, one for each.
    texts = docs.where(F.col("lang").isNotNull()).select(
        "doc_id", lang, F.col("text").cast("string").alias("text")
    ).join(F.broadcast(chosen.select("lang", "doc_id")), ["lang", "doc_id"]).select("doc_id", "lang", "text")
    found = texts.mapInPandas(spread, "doc_id long, lang string, windows array<binary>").groupBy("lang", "doc_id").agg(
        F.min("windows").alias("windows")
    ).collect()
    return [(row.lang, [bytes(w) for w in row.windows]) for row in sorted(found, key=lambda row: (row.lang, row.doc_id))]


def train(sample: list[tuple[str, list[bytes]]], training: Training = Training()) -> Network | None:
    languages = sorted({name for name, _ in sample})
    pairs = [(window, languages.index(name)) for name, windows in sample for window in windows]
    if not pairs:
        return None
    return Network(languages, training).fit([run for run, _ in pairs], np.array([k for _, k in pairs]))


def _identifier(shared) -> Identifier:
    return worker_state(f"language {shared._path}", lambda: Identifier(shared.value))


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score`` from the column ``text``; these names replace columns of the same name."""
    kept = [name for name in docs.columns if name not in ("lang_pred", "score")]
    if network is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = _identifier(shared).predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    found = docs.select(*kept, predicted(F.col(text).cast("string")).alias("language_found"))
    return found.select(*kept, "language_found.lang_pred", "language_found.score")


SPANS = "array<struct<lang:string,first:long,behind:long>>"


def labelled_spans(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``spans``: stretches of characters of ``text`` with one label each, as the positions are labelled."""
    kept = [name for name in docs.columns if name != "spans"]
    if network is None:
        return docs.select(*kept, F.array().cast(SPANS).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf(SPANS)
    def labelled(texts: pd.Series) -> pd.Series:
        own = _identifier(shared)
        names = ("lang", "first", "behind")
        return pd.Series([[dict(zip(names, span, strict=True)) for span in own.spans(text)] for text in texts])

    return docs.select(*kept, labelled(F.col("text").cast("string")).alias("spans"))


def learnt_network(docs: DataFrame, rule: F.Column | None = None, training: Training = Training()) -> Network | None:
    """A network trained on the rows of ``docs`` that ``rule`` admits (all with a language, by default)."""
    docs = docs.select("doc_id", "text", "lang")
    return train(learnt_sample(docs, F.lit(True) if rule is None else rule, training), training)


def learning_rule() -> F.Column:
    return training_row("doc_id", 4, 2)
