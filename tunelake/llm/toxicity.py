"""Toxic passages: maximum-scoring segments over token log-odds, judged by their extreme-value statistics.

1. A token (lower case, without punctuation around it) has features: itself, and every ``GRAM`` characters in a
   row with marks for its start and end, so that compounds and endings of a toxic word are met too. A feature's
   score is the log-odds of toxic against clean rows under a Dirichlet prior that follows its share of the whole
   corpus, moved towards 0 by ``CAUTION`` standard deviations. A token scores as its highest feature, less
   ``DRIFT``. Counts are of documents, not of repetitions. Features share ``BUCKETS`` scores by a hash, so the model
   has the same size for any corpus. The counts of the prior cover all documents. Tokens are runs without ASCII
   white space; a worker reads each different one once as far as it remembers, some texts at a time, in numpy.
2. In one pass over a document all maximal scoring segments are found (the segments that neither grow nor merge
   with a gain). Only tokens with a positive score can start or end one; the rest only lower running sums.
3. A segment of score ``S`` in ``n`` tokens has the expected number ``K n exp(-lambda S)`` in clean text: lambda
   solves ``sum p exp(lambda s) = 1`` for the shares of the scores in clean rows, K is the maximum-likelihood value over the clean
   rows. Segments with an expectation below ``SIGNIFICANT`` are the toxic passages.
4. A document's probability is a logistic function of its best segment's ``-log`` expectation and of the
   combined evidence of all significant segments, fitted to the rows learnt from.

Learning uses at most ``LEARNT_DOCS`` labelled rows, chosen by a hash of their ids; everything else covers all
rows and whole texts.

Rules: null and empty texts have no segment and the probability of a text without any. Labels that are null teach
nothing; several labels of one id count as the highest. Rows without id are scored, not learnt from; repeated rows
are scored alike. Without labels of both kinds the score is 0 for all. Other columns are not read. An empty table
gives an empty table.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import (
    Rows, SpanPlaces, distinct, pieces_of, sequence_hashes, text_chunks, training_row, word_hashes, worker_state, written,
)

BUCKETS = 1 << 20
GRAM = 5
CAUTION = 1.0
LEARNT_DOCS = 20_000
DRIFT = 1.5
SIGNIFICANT = 0.05
THRESHOLD = 0.7
#: Weight of the prior against the toxic tokens counted.
PRIOR_SHARE = 1.0

_EDGES = string.punctuation + "«»“”‘’…–—¿¡"


def _words(pieces: list[str]) -> list[str]:
    """Tokens in lower case without punctuation around them; those of punctuation alone are empty."""
    return [piece.lower().strip(_EDGES) for piece in pieces]


def token_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the words' features: word number and bucket, each pair once, by word."""
    full = [place for place, word in enumerate(words) if word]
    if not full:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marked = [f"^{words[place]}$" for place in full]
    whole = sequence_of_words(["=" + words[place] for place in full])
    data = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(full)), sizes)
    grams = sequence_hashes(data, GRAM) if len(data) >= GRAM else np.empty(0, np.uint64)
    inside = owner[:len(grams)] == owner[GRAM - 1:]
    number = np.concatenate([np.arange(len(full)), owner[:len(grams)][inside]])
    bucket = (np.concatenate([whole, grams[inside]]) & np.uint64(BUCKETS - 1)).astype(np.int64)
    pairs = distinct(number * BUCKETS + bucket)
    return np.array(full, np.int64)[pairs // BUCKETS], pairs % BUCKETS


def sequence_of_words(words: list[str]) -> np.ndarray:
    """A hash of each word, which is neither empty nor holds ASCII white space."""
    return word_hashes("\n".join(words))


def token_scores(pieces: list[str], feature_scores: np.ndarray) -> np.ndarray:
    """The score of each token: its highest feature, less ``DRIFT``; one of punctuation alone has the feature 0."""
    number, bucket = token_features(_words(pieces))
    scores = np.zeros(len(pieces))
    if len(number):
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        scores[number[first]] = np.maximum.reduceat(feature_scores[bucket], first)
    return scores - DRIFT


class TokenScores:
    """Scores the tokens of texts, remembering short tokens as far as ``SpanPlaces`` has room for them."""

    def __init__(self, feature_scores: np.ndarray):
        self.feature_scores = feature_scores
        self.known, self.held = SpanPlaces(), Rows(1, np.float64)

    def _add(self, pieces: list[bytes], keep: bool) -> int:
        found = token_scores([piece.decode() for piece in pieces], self.feature_scores)
        return self.held.add(found[:, None], keep)

    def of(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The score of every token of each text, in order."""
        for part in text_chunks(texts):
            data, starts, ends, bounds = pieces_of(part)
            places = self.known.of(data, starts, ends, self._add)
            scores = self.held.held[places, 0]
            for first, behind in zip(bounds, bounds[1:]):
                yield scores[first:behind]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, behind last, score)``, in linear time.

    Each positive value starts a candidate; a candidate is joined with the nearest earlier one that starts lower
    for as long as that one also ends lower.
    """
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []  # first, behind last, sum before, sum behind, lower start
    for place in np.nonzero(scores > 0)[0].tolist():
        first, left, right = place, float(totals[place]), float(totals[place + 1])
        while True:
            lower = len(found) - 1
            while lower >= 0 and found[lower][2] >= left:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= right:
                break
            first, left = found[lower][0], found[lower][2]
            del found[lower:]
        found.append((first, place + 1, left, right, lower))
    return [(first, last, right - left) for first, last, left, right, _ in found]


@dataclass
class Model:
    feature_scores: np.ndarray
    rate: float = 1.0
    volume: float = 1.0
    weights: np.ndarray = field(default_factory=lambda: np.array([-20.0, 0.0, 0.0]))
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The score of every token of each text, in order."""
        return worker_state(f"toxicity {self.name}", lambda: TokenScores(self.feature_scores)).of(texts)

    def passages(self, own: np.ndarray) -> list[tuple[int, int, float, float]]:
        """``first, behind last, score, expectation`` of every segment of a text, given by its tokens' scores."""
        return [(first, last, score, self.expectation(len(own), score)) for first, last, score in segments(own)]

    def expectation(self, size: int, score: float) -> float:
        """The number of segments with this score or more to expect in a clean text of ``size`` tokens."""
        return float(np.exp(min(50.0, np.log(max(1e-300, self.volume * max(1, size))) - self.rate * score)))

    def evidence(self, found: list[tuple[int, int, float, float]]) -> tuple[float, float]:
        """The best segment's evidence and the sum over the significant ones, both on a log scale."""
        if not found:
            return -5.0, 0.0
        logs = -np.log(np.maximum([f[3] for f in found], 1e-120))
        strong = logs[logs > -np.log(SIGNIFICANT)].sum()
        return float(np.clip(logs.max(), -5.0, 30.0)), float(np.log1p(strong))

    def probability(self, evidence: tuple[float, float]) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.weights @ [1.0, *evidence], -30, 30))))


def cautious_odds(
    corpus: np.ndarray, toxic: np.ndarray, clean: np.ndarray, sums: tuple[float, float, float], buckets: int = BUCKETS
) -> np.ndarray:
    """Log-odds by bucket, from counts of features in the corpus and in toxic and clean rows, and their sums.

    A feature that no row has would score 0.
    """
    strength = max(1.0, PRIOR_SHARE * sums[1])
    prior = strength * (corpus + 0.5) / (sums[0] + 0.5 * buckets)
    odds = [
        np.log((own + prior) / (total + strength - own - prior)) for own, total in ((toxic, sums[1]), (clean, sums[2]))
    ]
    difference = odds[0] - odds[1]
    deviation = np.sqrt(1.0 / (toxic + prior) + 1.0 / (clean + prior))
    return np.sign(difference) * np.maximum(0.0, np.abs(difference) - CAUTION * deviation)


def extreme_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of ``sum shares * exp(rate * scores) = 1``; the mean score has to be negative."""
    if not (shares[scores > 0] > 0).any():
        return 1.0
    while (shares * scores).sum() >= 0:  # so much evidence in clean text that segments would never end
        scores = scores - DRIFT
    low, high = 0.0, 1.0
    while (shares * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(np.minimum(middle * scores, 700))).sum() < 1 else (low, middle)
    return max(high, 1e-3)


def logistic(features: np.ndarray, truth: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression (the constant first), by Newton steps with halving."""
    x = np.column_stack([np.ones(len(features)), features])
    penalty = np.diag([0.0, *[ridge * len(x) / 100] * features.shape[1]])

    def cost(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - (truth * z).sum() + w @ penalty @ w / 2

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - truth) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), slope)
        size = 1.0
        while cost(w - size * step) > cost(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def learnt_rows(labels: DataFrame, rule: F.Column) -> DataFrame:
    """``doc_id, toxic`` of at most ``LEARNT_DOCS`` labelled rows, chosen by a hash of the id."""
    return labels.where(rule & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(LEARNT_DOCS)


def _counted(batches):
    """Counts by bucket of all that a task has read.

    Tokens are counted first, once per document, so that a document that repeats itself does not decide alone; the
    counts of tokens that are not remembered go to their buckets text by text.
    """
    known, counts = SpanPlaces(), np.zeros((3, BUCKETS), np.int64)
    tokens: list[bytes] = []
    times = Rows(3, np.int64)

    def add(pieces: list[bytes], keep: bool) -> int:
        if keep:
            tokens.extend(pieces)
        else:
            rare[:] = pieces
        return times.add(np.zeros((len(pieces), 3), np.int64), keep)

    def spread(pieces: list[bytes], own: np.ndarray) -> None:
        number, bucket = token_features(_words([piece.decode() for piece in pieces]))
        for row in range(3):
            counts[row] += np.bincount(bucket, weights=own[number, row], minlength=BUCKETS).astype(np.int64)

    for batch in batches:
        kinds, begin = batch["toxic"].fillna(-1).to_numpy(np.int64), 0
        for part in text_chunks(batch["text"].tolist()):
            rare: list[bytes] = []
            data, starts, ends, bounds = pieces_of(part)
            places = known.of(data, starts, ends, add)
            kind = kinds[begin:begin + len(part)]
            begin += len(part)
            width = int(places.max(initial=0)) + 1
            pairs = distinct(np.repeat(np.arange(len(part)), np.diff(bounds)) * width + places)
            document, place = pairs // width, pairs % width
            for row, counted in enumerate((slice(None), kind[document] == 1, kind[document] == 0)):
                times.held[:width, row] += np.bincount(place[counted], minlength=width)
            if rare:
                spread(rare, times.held[times.size:times.size + len(rare)])
    for first in range(0, len(tokens), 1 << 16):
        spread(tokens[first:first + (1 << 16)], times.held[first:first + (1 << 16)])
    used = np.nonzero(counts[0])[0]
    yield pd.DataFrame({
        "bucket": used, "corpus": counts[0, used], "toxic": counts[1, used], "clean": counts[2, used]
    })


#: Token scores are tallied in steps of this size from -LARGEST to LARGEST.
_STEP, _LARGEST = 0.05, 30.0
_GRID = np.arange(-_LARGEST, _LARGEST + _STEP / 2, _STEP)


def _tally(scores: np.ndarray) -> np.ndarray:
    places = np.rint((np.clip(scores, -_LARGEST, _LARGEST) + _LARGEST) / _STEP).astype(np.int64)
    return np.bincount(places, minlength=len(_GRID))


def _feature_scores(texts: DataFrame, sample: DataFrame) -> np.ndarray | None:
    """The score of every bucket; only those that are not 0 come to the driver. None without tokens of both kinds."""
    counts = written(texts.join(sample, "doc_id", "left").select("text", "toxic").mapInPandas(
        _counted, "bucket long, corpus long, toxic long, clean long"
    ).groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "toxicity-counts")
    sums = tuple(float(total or 0) for total in counts.agg(F.sum("corpus"), F.sum("toxic"), F.sum("clean")).first())
    if not sums[1] or not sums[2]:
        return None

    def odds(batches):
        for batch in batches:
            given = [batch[name].to_numpy(np.float64) for name in ("corpus", "toxic", "clean")]
            own = pd.DataFrame({"bucket": batch["bucket"], "odds": cautious_odds(*given, sums)})
            yield own[own["odds"] != 0]

    found = counts.mapInPandas(odds, "bucket long, odds double").toArrow()  # of ``BUCKETS`` lines at most
    scores = np.zeros(BUCKETS, np.float32)
    scores[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return scores


def _tallied(shared):
    """The tokens of rows of either kind by score: ``toxic, place, tokens``."""
    def tallied(batches):
        tallies = np.zeros((2, len(_GRID)), np.int64)
        for batch in batches:
            for scores, toxic in zip(shared.value.scores(batch["text"].tolist()), batch["toxic"], strict=True):
                tallies[int(toxic)] += _tally(scores)
        kind, place = np.nonzero(tallies)
        yield pd.DataFrame({"toxic": kind, "place": place, "tokens": tallies[kind, place]})

    return tallied


def _described(shared, rate: float):
    """A line per row: its number of tokens, and its segments' scores as far as its evidence needs them."""
    def described(batches):
        for batch in batches:
            rows = []
            for scores, toxic in zip(shared.value.scores(batch["text"].tolist()), batch["toxic"], strict=True):
                parts = [part[2] for part in segments(scores)]
                best = max(parts, default=0.0)
                rows.append((int(toxic), len(scores), len(scores) * float(np.exp(-rate * best))))
            yield pd.DataFrame(rows, columns=["toxic", "size", "expected"])

    return described


def _evidence(shared, model: Model):
    def evidence(batches):
        for batch in batches:
            rows = []
            for doc_id, scores, toxic in zip(
                batch["doc_id"], shared.value.scores(batch["text"].tolist()), batch["toxic"], strict=True
            ):
                rows.append((doc_id, int(toxic), *model.evidence(model.passages(scores))))
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "best", "all"])

    return evidence


def learn(docs: DataFrame, labels: DataFrame, rule: F.Column | None = None) -> Model | None:
    """A model from the labels that ``rule`` admits (all, by default); None without labels of both kinds.

    The rows learnt from are written once, one text (the first by its characters) for each id. What comes to the
    driver is the sample's ids, the buckets' scores, one line per step of the tally, and two numbers per row learnt
    from; none of these depends on the length of texts or on how often an id is repeated.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = [tuple(row) for row in learnt_rows(labels, F.lit(True) if rule is None else rule).collect()]
    if len({toxic for _, toxic in chosen}) < 2:
        return None
    sample = F.broadcast(spark.createDataFrame(chosen, "doc_id long, toxic int"))  # LEARNT_DOCS rows at most
    feature_scores = _feature_scores(texts, sample)
    if feature_scores is None:
        return None
    model = Model(feature_scores)
    shared = spark.sparkContext.broadcast(model)
    learnt = written(
        texts.join(sample, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample"
    )
    tallies = np.zeros((2, len(_GRID)))
    for toxic, place, tokens in learnt.select("text", "toxic").mapInPandas(
        _tallied(shared), "toxic int, place int, tokens long"
    ).groupBy("toxic", "place").agg(F.sum("tokens")).collect():
        tallies[toxic, place] = tokens
    clean = tallies[0] + 0.5 * (tallies[1] > 0)
    model.rate = extreme_rate(_GRID, clean / clean.sum())
    rows, expected = learnt.select("text", "toxic").mapInPandas(
        _described(shared, model.rate), "toxic int, size long, expected double"
    ).where("toxic = 0 AND size > 0").agg(F.count("*"), F.sum("expected")).first()
    model.volume = rows / max(expected, 1e-9) if rows else 1.0
    found = learnt.select("doc_id", "text", "toxic").mapInPandas(
        _evidence(shared, model), "doc_id long, toxic int, best double, all double"
    ).toPandas().sort_values("doc_id")
    truth = found["toxic"].to_numpy(np.float64)
    if 0 < truth.sum() < len(truth):
        model.weights = logistic(found[["best", "all"]].to_numpy(np.float64), truth)
    return model


PASSAGES = "array<struct<first_token:long,end_token:long,score:double,expectation:double>>"


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` and the significant ``passages``; these names replace columns of the same name."""
    kept = [name for name in docs.columns if name not in ("score", "passages")]
    if model is None:
        return docs.select(*kept, F.lit(0.0).alias("score"), F.array().cast(PASSAGES).alias("passages"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"score double, passages {PASSAGES}")
    def judged(texts: pd.Series) -> pd.DataFrame:
        scores, passages, own = [], [], shared.value
        for tokens in own.scores(texts.tolist()):
            found = own.passages(tokens)
            scores.append(own.probability(own.evidence(found)))
            passages.append([
                {"first_token": first, "end_token": last, "score": score, "expectation": expectation}
                for first, last, score, expectation in found if expectation < SIGNIFICANT
            ])
        return pd.DataFrame({"score": scores, "passages": passages})

    found = docs.select(*kept, judged(F.col("text").cast("string")).alias("toxicity_found"))
    return found.select(*kept, "toxicity_found.score", "toxicity_found.passages")


def learning_rule() -> F.Column:
    return training_row("doc_id", 3, 1)
