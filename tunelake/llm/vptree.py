"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

A shard is some ``SHARD_ROWS`` rows that a task reads one after the other. Its tree halves the rows by their distance
to a vantage point; a child knows the smallest and largest distance ``a, b`` of its rows to the vantage point ``v``
and their largest length ``P``. By the triangle inequality no row ``p`` of a child is nearer to a query ``q`` than
``l = max(0, |q - v| - b, a - |q - v|)``, so its product with ``q`` is at most the smallest of ``(|q|^2 + P^2 - l^2) / 2``,
``q v + |q| b`` and ``|q| P``. A child is left out if this bound is below the last score that the query would keep.
``relax`` multiplies ``l`` and divides ``b``: factor 1 is exact search, larger ones leave out more and may miss
neighbours. Bounds are widened by what rounding may change, in proportion to the lengths of the query and of the
child's rows alone, so that one long vector costs the others nothing. Vectors are scaled by powers of two for the search, so that
no length is too large.

A task carries the best rows of each query from shard to shard, and its list is merged with those of other tasks by a
window. Queries come in rounds of about ``ROUND_NUMBERS`` components (32 MB) that are broadcast; with more queries there
are more rounds, and each reads all rows again. Rows are not shuffled. Scores are sums of products in double
precision of the original vectors (where such a sum overflows, that of the scaled ones, scaled back); ties go to the smaller id.

Rules: null or zero vectors, vectors that hold a null or a value that is not finite, and rows without id take no
part. Only vectors of one size meet. Repeated ids are separate candidates, a query's own row means every row of its
id, and query rows that are repeated whole are one query. Other columns are not read. An empty table, or one without
queries, gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import Best, vector_chunks, written

SHARD_ROWS = 16_384
#: Large leaves keep the work in a few large products; smaller ones prune more where vectors cluster.
LEAF_ROWS = 512
#: Queries that go down a tree together, and components of the queries of a round.
QUERY_ROWS, ROUND_NUMBERS = 1024, 4_000_000
NEIGHBOURS = 20
_EPS = float(np.finfo(np.float64).eps)
_LARGEST = float(np.finfo(np.float64).max)


def exponents(vectors: np.ndarray) -> np.ndarray:
    """The power of two above the largest component of each vector."""
    return np.frexp(np.abs(vectors).max(axis=1))[1] if vectors.size else np.zeros(len(vectors), np.int64)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; infinite only where the product itself is beyond double precision."""
    with np.errstate(over="ignore", invalid="ignore"):
        sums = (a * b).sum(axis=1)
        odd = np.flatnonzero(~np.isfinite(sums))
        if len(odd):
            up, down = exponents(a[odd]), exponents(b[odd])
            scaled = (np.ldexp(a[odd], -up[:, None]) * np.ldexp(b[odd], -down[:, None])).sum(axis=1)
            sums[odd] = np.ldexp(scaled, up + down)
    return sums


class Tree:
    """A vantage-point tree over the rows of a matrix, none longer than about the root of its width."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points, leaf
        self.lengths = np.sqrt(np.square(points).sum(axis=1))
        self.nodes: list[tuple] = []
        self.made = 0  # products in leaves
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        if len(rows) <= self.leaf:
            self.nodes.append(("leaf", rows, float(self.lengths[rows].max(initial=0.0))))
            return len(self.nodes) - 1
        # The row farthest from the mean sees the others at the most different distances.
        centre = self.points[rows].mean(axis=0)
        vantage = rows[np.square(self.points[rows] - centre).sum(axis=1).argmax()]
        distance = np.sqrt(np.square(self.points[rows] - self.points[vantage]).sum(axis=1))
        order = np.argsort(distance, kind="stable")
        place = len(self.nodes)
        self.nodes.append(())
        # Rows at the same distance may stand on both sides: the bounds are those of the rows, not of the median.
        halves = order[:len(rows) // 2], order[len(rows) // 2:]
        self.nodes[place] = ("node", int(vantage), [
            (float(distance[half].min()), float(distance[half].max()), float(self.lengths[rows[half]].max()),
             self._build(rows[half])) for half in halves
        ])
        return place

    def search(self, queries: np.ndarray, least, offer, relax: float = 1.0) -> None:
        """Goes down the tree with all ``queries`` (rows of about the points' size).

        ``least(places)`` is the score a row must reach to be of use to these queries, and ``offer(places, rows)``
        takes pairs of a query and a row that may reach it. A leaf's rows are offered with a product within rounding
        of the best ``offer.count`` of the leaf.
        """
        self.queries, self.least, self.offer, self.relax = queries, least, offer, relax
        self.sizes = np.sqrt(np.square(queries).sum(axis=1))
        self.slack = 8.0 * _EPS * (queries.shape[1] + 4)
        self._visit(self.root, np.arange(len(queries)))

    def _visit(self, place: int, asked: np.ndarray) -> None:
        node = self.nodes[place]
        if node[0] == "leaf":
            self._leaf(node[1], node[2], asked)
            return
        _, vantage, children = node
        point, size = self.points[vantage], self.sizes[asked]
        product = self.queries[asked] @ point
        # Differences, not a sum of squares: a vantage point near the query may be far from 0.
        distance = np.sqrt(np.square(self.queries[asked] - point).sum(axis=1))
        bounds = []
        for near, far, longest, _ in children:
            rounding = self.slack * (size + longest + self.lengths[vantage])
            low = np.maximum(0.0, np.maximum(distance - far, near - distance) - rounding) * self.relax
            bound = np.minimum((size * size + longest * longest - low * low) / 2, product + size * far / self.relax)
            bounds.append(np.minimum(bound, size * longest) + self.slack * (size + longest) * (size + longest))
        # Each query goes first where more may be found, so that its worst neighbour is good before the other half.
        first = bounds[0] >= bounds[1]
        for turn in (True, False):
            for (_, _, _, child), bound, own in zip(children, bounds, (first, ~first), strict=True):
                going = (own if turn else ~own) & (bound >= self.least(asked))
                if going.any():
                    self._visit(child, asked[going])

    def _leaf(self, rows: np.ndarray, longest: float, asked: np.ndarray) -> None:
        self.made += len(asked) * len(rows)
        products = self.queries[asked] @ self.points[rows].T
        margin = self.slack * self.sizes[asked] * longest
        wanted = self.least(asked) - margin
        taken = self.offer.most(asked)
        if len(rows) > taken:
            kth = np.partition(products, len(rows) - taken, axis=1)[:, len(rows) - taken]
            wanted = np.maximum(wanted, kth - 2 * margin)
        near, column = np.nonzero(products >= wanted[:, None])
        self.offer(asked[near], rows[column])


class Queries:
    """Queries of one vector size; ``numbers`` tells them apart within a round, and ``repeats`` their ids' rows."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.numbers, self.ids, self.vectors = numbers, ids, vectors
        self.exponents = exponents(vectors)
        self.scaled = np.ldexp(vectors, -self.exponents[:, None])


class Found:
    """What a task has found for its queries; offered rows are scored on the original vectors."""

    def __init__(self, queries: Queries, count: int):
        self.queries, self.count = queries, count
        self.best = Best(len(queries.ids), count, np.float64)

    def search(self, ids: np.ndarray, vectors: np.ndarray, relax: float) -> int:
        """Searches a shard for all queries; the number of products made in leaves."""
        exponent = int(exponents(vectors).max(initial=-5000))
        tree = Tree(np.ldexp(vectors, -exponent), LEAF_ROWS)
        self.shard_ids, self.shard = ids, vectors
        # A leaf may hold as many rows of a query's own id as the shard has.
        own = pd.Series(ids[np.isin(ids, self.queries.ids)]).value_counts()
        self.own = own.reindex(self.queries.ids, fill_value=0).to_numpy()
        for begin in range(0, len(self.queries.ids), QUERY_ROWS):
            self.part = slice(begin, begin + QUERY_ROWS)
            self.begin = begin
            self.shift = self.queries.exponents[self.part] + exponent
            tree.search(self.queries.scaled[self.part], self._least, self, relax)
        return tree.made

    def _least(self, places: np.ndarray) -> np.ndarray:
        """The worst score kept, as a product of scaled vectors."""
        worst = self.best.worst[self.begin + places]
        with np.errstate(over="ignore", under="ignore"):
            scaled = np.ldexp(np.clip(worst, -_LARGEST, _LARGEST), -self.shift[places])
        return np.where(np.isneginf(worst) & (self.best.held[self.begin + places] < self.count), -np.inf, scaled)

    def most(self, places: np.ndarray) -> int:
        return self.count + int(self.own[self.begin + places].max(initial=0))

    def __call__(self, places: np.ndarray, rows: np.ndarray) -> None:
        slots = self.begin + places
        other = self.queries.ids[slots] != self.shard_ids[rows]
        slots, rows = slots[other], rows[other]
        for at in range(0, len(slots), 1 << 18):
            own, row = slots[at:at + (1 << 18)], rows[at:at + (1 << 18)]
            scores = inner_products(self.queries.vectors[own], self.shard[row])
            useful = scores >= self.best.worst[own]
            self.best.add(own[useful], scores[useful], self.shard_ids[row[useful]])

    def rows(self) -> pd.DataFrame:
        slot, scores, ids = self.best.found()
        return pd.DataFrame({
            "query": self.queries.numbers[slot], "query_id": self.queries.ids[slot], "vec_id": ids, "score": scores
        })


def _searched(shared, count: int, relax: float):
    def searched(batches):
        given, kept = shared.value, {}
        for size, rows in vector_chunks(batches, SHARD_ROWS):
            if size not in given:
                continue
            if size not in kept:
                kept[size] = Found(given[size], count)
            ids, vectors = rows["vec_id"].to_numpy(np.int64), np.stack(rows["vector"].to_list()).astype(np.float64)
            for begin in range(0, len(rows), SHARD_ROWS):
                kept[size].search(ids[begin:begin + SHARD_ROWS], vectors[begin:begin + SHARD_ROWS], relax)
        for own in kept.values():
            yield own.rows()

    return searched


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (array of doubles) of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).where(
        F.exists("vector", lambda x: x != 0)
    )


def nearest(
    vectors: DataFrame, queries: F.Column, count: int = NEIGHBOURS, relax: float = 1.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of ``vectors (vec_id, embedding)`` to those ``queries`` picks.

    ``queries`` is a condition on ``vec_id``.
    """
    if relax < 1.0:
        raise ValueError("relax is 1 or more")
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    asked = written(rows.where(queries).distinct(), "vector-queries")
    numbers = asked.agg(F.sum(F.size("vector") + 2)).first()[0] or 0
    rounds = -(-numbers // ROUND_NUMBERS)
    results = []
    for number in range(rounds):
        part = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(rounds)) == number
        own = asked.where(part).orderBy("vec_id", "vector").toPandas()
        if not len(own):
            continue
        shared = spark.sparkContext.broadcast({
            int(size): Queries(
                group.index.to_numpy(np.int64), group["vec_id"].to_numpy(np.int64),
                np.stack(group["vector"].to_list()).astype(np.float64),
            ) for size, group in own.groupby(own["vector"].map(len))
        })
        found = rows.mapInPandas(
            _searched(shared, count, relax), "query long, query_id long, vec_id long, score double"
        )
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        results.append(written(
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count), "neighbours"
        ))
        shared.unpersist()
    if not results:
        return spark.range(0).selectExpr(
            "id AS query_id", "CAST(NULL AS INT) AS rank", "CAST(NULL AS LONG) AS vec_id", "CAST(NULL AS DOUBLE) AS score"
        )
    union = results[0]
    for other in results[1:]:
        union = union.unionByName(other)
    return union.select("query_id", "rank", "vec_id", "score")
