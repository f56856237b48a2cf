"""Hard negatives by lists that the anchors of a cluster share, walked until nothing better can follow.

Anchors are clustered by direction. For a cluster with centre ``c`` and widest angle ``w`` between centre and member,
no member ``u`` has an inner product with a row ``x`` above ``|u| |x| cos(max(0, angle(c, x) - w))``. The rows are
sorted once per cluster by ``|x| cos(…)``, largest first, and every member walks this one list, some rows at a time,
with exact products. It stops when the bound of the next row cannot reach the last score it would keep: the result
is exact, whatever the clusters are. In directions without structure the bounds are wide and much of a list is walked.

There are two walks. The first finds an anchor's *positives*, the best other rows of its label. The second finds, for
each positive, the best rows of other labels whose score lies in a window below the positive's (whole percentages
of it, ends included); it may also stop at the window's lower end.

Each walk reads all rows once. A task holds some rows at a time, sorts them for each cluster and carries what its
anchors have found so far to the next rows; the tasks' lists are merged by a window. Anchors come in rounds of about
``ROUND_NUMBERS`` components (32 MB), which are clustered by the driver and broadcast; with more anchors there are
more rounds, each of which reads all rows again. Nothing else is gathered.

Vectors are whole numbers, so scores are exact. A product beyond 64 bits counts as the largest or smallest 64-bit
number.

Rules: rows without id, label or vector, or with a null component, take no part. Only vectors of one size meet.
Ties go to the smaller id, of equal ids to any. Rows repeated whole are one anchor; as positives and negatives each
counts. Rows with an anchor's id are not other rows. A positive with a negative score has an empty window. Zero
vectors take part, with score 0. Other columns are not read. An empty table, or one without anchors, gives an empty
table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import Best, vector_chunks, written

#: Components of the anchors of a round.
ROUND_NUMBERS = 4_000_000
#: Rows that a task holds at most, for each vector size.
CHUNK_ROWS = 16_384
#: Members of a cluster that walk together, and rows that they take at first and at most.
WALKING, FIRST_STEP, MOST_STEP = 256, 128, 2048
_LIMIT = 2**63 - 1
#: Largest sum of products that doubles hold exactly.
_EXACT = 2.0**52
#: Widens the bounds beyond the rounding of angles and products.
_ANGLE, _RELATIVE = 1e-7, 1e-9


@dataclass(frozen=True)
class Rule:
    """How many positives and negatives, and the window of the negatives in percent of the positive's score."""

    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90


# --- anchors --------------------------------------------------------------------------------------------

def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions (zeros stay zeros) and lengths."""
    given = vectors.astype(np.float64)
    lengths = np.sqrt(np.square(given).sum(axis=1))
    return given / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def _angles(directions: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ centre, -1.0, 1.0))


def clustered(directions: np.ndarray, steps: int = 4, seed: int = 5) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """Centre, widest angle and members of about the root of as many clusters, by spherical k-means."""
    count = max(1, int(np.sqrt(len(directions))))
    centres = directions[np.random.default_rng(seed).choice(len(directions), count, replace=False)]
    for _ in range(steps):
        nearest = (directions @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, directions)
        lengths = np.linalg.norm(sums, axis=1)
        centres = np.where(lengths[:, None] > 1e-9, sums / np.maximum(lengths, 1e-9)[:, None], centres)
    nearest = (directions @ centres.T).argmax(axis=1)
    own = [(centre, np.flatnonzero(nearest == k)) for k, centre in enumerate(centres)]
    return [(centre, float(_angles(directions[at], centre).max()), at) for centre, at in own if len(at)]


class Anchors:
    """Anchors of one vector size; ``numbers`` tells them apart within a round."""

    def __init__(self, numbers, ids, labels, vectors):
        self.numbers, self.ids, self.labels, self.vectors = numbers, ids, labels, vectors
        directions, self.lengths = _unit(vectors)
        self.clusters = clustered(directions)


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond 64 bits are the nearest 64-bit number."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    rough = anchors.astype(np.float64) @ rows.T.astype(np.float64)
    largest = float(np.abs(anchors.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max())
    if largest * anchors.shape[1] < _EXACT:
        return rough.astype(np.int64)
    with np.errstate(over="ignore"):
        exact = anchors @ rows.T  # wraps, and so is right wherever the sum fits
    return np.where(rough >= 2.0**63, _LIMIT, np.where(rough <= -(2.0**63), -_LIMIT, exact))


# --- the walk -------------------------------------------------------------------------------------------

class Positives:
    """The best other rows of an anchor's label."""

    def __init__(self, anchors: Anchors, rule: Rule):
        self.anchors, self.best = anchors, Best(len(anchors.ids), rule.positives)

    def least(self, members: np.ndarray) -> np.ndarray:
        """The score that a row must reach to be of use to each member."""
        return self.best.worst[members]

    def offer(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        own = self.anchors
        useful = (own.labels[members][:, None] == labels) & (own.ids[members][:, None] != ids)
        useful &= scores >= self.best.worst[members][:, None]
        at, row = np.nonzero(useful)
        self.best.add(members[at], scores[at, row], ids[row])

    def rows(self) -> pd.DataFrame:
        slot, scores, ids = self.best.found()
        return pd.DataFrame({"anchor": self.anchors.numbers[slot], "vec_id": ids, "score": scores})


class Negatives:
    """For each target (an anchor's positive) the best rows of other labels within its window."""

    def __init__(self, anchors: Anchors, targets: pd.DataFrame, rule: Rule):
        place = pd.Series(np.arange(len(anchors.numbers)), index=anchors.numbers)
        targets = targets[targets["anchor"].isin(place.index)]
        self.targets, self.anchors = targets, anchors
        member = place[targets["anchor"]].to_numpy(np.int64)
        order = np.argsort(member, kind="stable")
        self.targets, self.member = targets.iloc[order], member[order]
        scores = [int(score) for score in self.targets["score"]]
        self.low = np.array([-(-rule.least_percent * score // 100) for score in scores], np.int64)
        self.high = np.array([rule.most_percent * score // 100 for score in scores], np.int64)
        self.bounds = np.searchsorted(self.member, np.arange(len(anchors.ids) + 1))
        self.best = Best(len(scores), rule.negatives)

    def _of(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The targets of the members, and the place of each one's member."""
        counts = self.bounds[members + 1] - self.bounds[members]
        owner = np.repeat(np.arange(len(members)), counts)
        ends = np.cumsum(counts)
        return np.arange(len(owner)) + np.repeat(self.bounds[members] - (ends - counts), counts), owner

    def least(self, members: np.ndarray) -> np.ndarray:
        targets, owner = self._of(members)
        needed = np.maximum(self.best.worst[targets], self.low[targets])
        needed = np.where(self.low[targets] <= self.high[targets], needed, np.inf)
        least = np.full(len(members), np.inf)
        np.minimum.at(least, owner, needed)
        return least

    def offer(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        targets, owner = self._of(members)
        given = scores[owner]
        useful = (given >= self.low[targets][:, None]) & (given <= self.high[targets][:, None])
        useful &= (self.anchors.labels[members][:, None] != labels)[owner]
        useful &= given >= self.best.worst[targets][:, None]
        # A row of another label may have the anchor's id.
        useful &= (self.anchors.ids[members][:, None] != ids)[owner]
        at, row = np.nonzero(useful)
        self.best.add(targets[at], given[at, row], ids[row])

    def rows(self) -> pd.DataFrame:
        slot, scores, ids = self.best.found()
        own = self.targets.iloc[slot]
        return pd.DataFrame({
            "anchor": own["anchor"].to_numpy(), "target": own["target"].to_numpy(),
            "anchor_id": own["anchor_id"].to_numpy(), "positive_id": own["vec_id"].to_numpy(),
            "positive_score": own["score"].to_numpy(), "negative_id": ids, "negative_score": scores,
        })


def walk(kept: Positives | Negatives, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> int:
    """Offers the rows to ``kept``, cluster by cluster; the number of products made."""
    anchors, made = kept.anchors, 0
    directions, lengths = _unit(vectors)
    for centre, widest, members in anchors.clusters:
        least_angle = np.maximum(0.0, _angles(directions, centre) - widest - _ANGLE)
        reach = lengths * np.cos(least_angle)
        order = np.argsort(-reach, kind="stable")
        reach = reach[order]
        for begin in range(0, len(members), WALKING):
            walking, at, step = members[begin:begin + WALKING], 0, FIRST_STEP
            while at < len(order):
                most = anchors.lengths[walking] * reach[at]
                most += np.abs(most) * _RELATIVE + _RELATIVE
                walking = walking[most >= kept.least(walking)]
                if not len(walking):
                    break
                rows = order[at:at + step]
                made += len(walking) * len(rows)
                kept.offer(walking, products(anchors.vectors[walking], vectors[rows]), ids[rows], labels[rows])
                at, step = at + step, min(MOST_STEP, 2 * step)
    return made


# --- tasks ----------------------------------------------------------------------------------------------

def _walked(broadcast, collector):
    def walked(batches):
        given, kept = broadcast.value, {}
        for size, rows in vector_chunks(batches, CHUNK_ROWS):
            if size not in given:
                continue
            if size not in kept:
                kept[size] = collector(given, size)
            ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
            vectors = np.stack(rows["vector"].to_list()).astype(np.int64) if size else np.zeros((len(rows), 0), np.int64)
            for begin in range(0, len(rows), CHUNK_ROWS):
                part = slice(begin, begin + CHUNK_ROWS)
                walk(kept[size], ids[part], labels[part], vectors[part])
        for own in kept.values():
            yield own.rows()

    return walked


# --- rows -----------------------------------------------------------------------------------------------

def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector``: components as ``floor(scale * x)``, of rows whose components are finite numbers.

    A component beyond 64 bits is the nearest number that doubles and 64 bits both hold.
    """
    limit = float(2**63 - 1024)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.lit(float(scale)) * x))))
    return embeddings.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("embedding").isNotNull() & finite).select("vec_id", "label", whole.cast("array<long>").alias("vector"))


def _round(rows: pd.DataFrame) -> tuple[dict[int, Anchors], pd.DataFrame]:
    """The anchors by vector size, numbered in the order of the rows."""
    rows = rows.reset_index(drop=True)
    return {
        int(size): Anchors(
            own.index.to_numpy(np.int64), own["vec_id"].to_numpy(np.int64), own["label"].to_numpy(np.int64),
            np.stack(own["vector"].to_list()).astype(np.int64) if size else np.zeros((len(own), 0), np.int64),
        ) for size, own in rows.groupby(rows["vector"].map(len))
    }, rows


def _first(found: DataFrame, by: list[str], order: list, count: int) -> DataFrame:
    own = Window.partitionBy(*by).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= count)


def hard_negatives(vectors: DataFrame, anchors: F.Column, rule: Rule = Rule()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors (vec_id, label, vector)``.

    ``anchors`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        F.forall("vector", lambda x: x.isNotNull())
    )
    rows = written(given, "negatives-rows")
    asked = written(rows.where(anchors).distinct(), "negatives-anchors")
    numbers = asked.agg(F.sum(F.size("vector") + 2)).first()[0] or 0
    rounds = -(-numbers // ROUND_NUMBERS)
    results = []
    for number in range(rounds):
        part = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(rounds)) == number
        by_size, listed = _round(asked.where(part).orderBy("vec_id", "label", "vector").toPandas())
        if not by_size:
            continue
        shared = spark.sparkContext.broadcast(by_size)
        found = rows.mapInPandas(
            _walked(shared, lambda own, size: Positives(own[size], rule)), "anchor long, vec_id long, score long"
        )
        # At most ``rule.positives`` rows for each anchor of the round.
        targets = _first(found, ["anchor"], [F.desc("score"), "vec_id"], rule.positives).toPandas()
        targets = targets.rename(columns={"rank": "target"}).sort_values(["anchor", "target"], ignore_index=True)
        targets["anchor_id"] = listed["vec_id"].to_numpy()[targets["anchor"].to_numpy(np.int64)]
        with_targets = spark.sparkContext.broadcast(targets)
        negatives = rows.mapInPandas(
            _walked(shared, lambda own, size, t=with_targets: Negatives(own[size], t.value, rule)),
            "anchor long, target long, anchor_id long, positive_id long, positive_score long, negative_id long, "
            "negative_score long",
        )
        results.append(written(
            _first(negatives, ["anchor", "target"], [F.desc("negative_score"), "negative_id"], rule.negatives),
            "negatives-found",
        ))
        shared.unpersist()
        with_targets.unpersist()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not results:
        empty = spark.range(0).select(F.col("id").alias("anchor_id"))
        return empty.selectExpr("anchor_id", *(f"CAST(NULL AS {'INT' if n == 'rank' else 'LONG'}) AS {n}" for n in names[1:]))
    union = results[0]
    for other in results[1:]:
        union = union.unionByName(other)
    return union.select(*names)
