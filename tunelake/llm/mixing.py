"""Mix sources to target weights by entropy balancing, in whole copies of documents.

The mix takes document ``i`` at the rate ``r_i = min(max_rate, exp(lambda_source + offset_i))``: of all rates that
meet the token constraint of every source, those closest (in relative entropy, per word) to the prior rates
``exp(offset_i)``. The multipliers are the solution of the convex dual, found by Newton steps; each step is one
aggregate over the documents by source. Rates are rounded into whole copies so that the words taken from a source
stay close to its target.

Rules: a null text has no words; a document without words is taken as its rate says but adds nothing. Repeated
rows (one id, source and text) are separate documents; the copies of all of them together are rounded, so that each
gets the whole number below its rate or the one above. Which get one more follows from their other columns. A null
source is a source of its own, after all others. Null ids are mixed like any other. An empty table gives an empty
table. The same rows give the same mix, however they are partitioned.

The driver holds one line per source (``MAX_SOURCES`` at most, else an error), never lines per document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_RATE = 3.0
MAX_SOURCES = 1_000_000
#: Up to so many, the lines per source (about 100 bytes each) are broadcast; beyond that Spark shuffles.
BROADCAST_SOURCES = 50_000
#: Documents that are rounded together; a source has as many such groups as it needs.
ROUNDED_TOGETHER = 4096
#: Into so many the different rows of one document are dealt to be ordered.
BUCKETS = 1024
NEWTON_STEPS = 50


def words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def target_sizes(sizes: Sequence[int], weights: Sequence[float], total: float, max_rate: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``max_rate`` times its size, the excess shared again by weight."""
    targets, open_places, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_places:
        weight = math.fsum(weights[i] for i in open_places)
        shares = {i: left * weights[i] / weight for i in open_places}
        full = [i for i in open_places if shares[i] >= max_rate * sizes[i]]
        if not full:
            for i in open_places:
                targets[i] = shares[i]
            break
        for i in full:
            targets[i] = max_rate * sizes[i]
        left = max(0.0, left - math.fsum(targets[i] for i in full))
        open_places = [i for i in open_places if i not in set(full)]
    return targets


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE
) -> list[tuple[str | None, int, int, float]]:
    """Per source: name, different documents, words, target; weights repeat over the sources by code point."""
    totals = sized.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum(F.col("size") * F.col("rows")).alias("source_size")
    )
    rows = totals.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda row: (row.source is None, row.source or ""))
    sizes = [row.source_size for row in rows]
    targets = target_sizes(sizes, [weights[i % len(weights)] for i in range(len(rows))], sum(sizes), max_rate)
    return [(row.source, row.docs, row.source_size, target) for row, target in zip(rows, targets, strict=True)]


def _few(rows: DataFrame, number: int) -> DataFrame:
    return F.broadcast(rows) if number <= BROADCAST_SOURCES else rows


def multipliers(
    sized: DataFrame, targets: list[tuple], max_rate: float = MAX_RATE, tolerance: float = 1e-10
) -> dict[str | None, float]:
    """The dual solution, lambda by source, by Newton steps over the documents.

    The dual of a source is convex with gradient ``sum(size * rate) - target`` and curvature ``sum(size * rate)``
    over the documents below the highest rate. A source whose target is all it can give needs no finite
    multiplier: it takes every document at the highest rate.
    """
    spark = sized.sparkSession
    # Equal (source, offset) enter every sum alike, so the steps run over their totals.
    cells = written(sized.groupBy("source", "offset").agg(F.sum(F.col("size") * F.col("rows")).alias("size")).where("size > 0"), "mix-cells")
    wanted = {source: target for source, _, _, target in targets}
    solved = {
        source: math.inf if target >= max_rate * size else 0.0 if target > 0 else -math.inf
        for source, _, size, target in targets
    }
    active = [source for source, value in solved.items() if math.isfinite(value)]
    for _ in range(NEWTON_STEPS):
        if not active:
            break
        now = spark.createDataFrame([(s, solved[s]) for s in active], "source string, lambda double")
        rate = F.exp(F.col("lambda") + F.col("offset"))
        sums = cells.join(_few(now, len(active)), cells.source.eqNullSafe(now.source)).groupBy(now.source).agg(
            F.sum(F.col("size") * F.least(rate, F.lit(max_rate))).alias("taken"),
            F.sum(F.when(rate < max_rate, F.col("size") * rate).otherwise(0.0)).alias("curvature"),
        ).collect()
        active = []
        for row in sums:
            gap = wanted[row.source] - row.taken
            if abs(gap) <= tolerance * max(1.0, wanted[row.source]):
                continue
            step = gap / row.curvature if row.curvature > 0 else math.copysign(1.0, gap)
            solved[row.source] += max(-2.0, min(2.0, step))
            active.append(row.source)
    return solved


def _copies(group: pd.DataFrame) -> pd.DataFrame:
    """Whole copies, long documents first, each rounded to what brings the words taken closest to the words due.

    The copies that all rows of a document are due together are rounded up or down to a neighbouring whole number,
    so the words taken stay within half a row of the words due, and the short documents at the end close that gap.
    Every row gets ``copies``, and ``extra`` of the rows one more.
    """
    group = group.sort_values(["size", "place", "doc_id"], ascending=[False, True, True], kind="stable")
    due = taken = 0.0
    copies, extra = [], []
    for size, rows, rate in zip(group["size"].tolist(), group["rows"].tolist(), group["rate"].tolist(), strict=True):
        due += size * rows * rate
        low = math.floor(rows * rate + 1e-9)
        up = rows * rate - low > 1e-9 and (due - taken - size * low) * 2 > size
        copies.append((low + int(up)) // rows)
        extra.append((low + int(up)) % rows)
        taken += size * (low + int(up))
    group["copies"], group["extra"] = copies, extra
    return group


def _row_keys() -> list[F.Column]:
    """What identifies a document: its source, its id, and a hash of id and text that also spreads it."""
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return [
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.lit(17), F.col("doc_id").cast("long"), content).alias("place"),
    ]


def _rounded(
    docs: DataFrame, weights: Sequence[float], max_rate: float, offset: F.Column | None,
) -> tuple[DataFrame, bool]:
    """One row per different document, with the number of its ``rows``, the ``copies`` that each of them gets, and
    how many of them get one ``extra``. Also whether any document has more than one row.
    """
    prior = (F.lit(0.0) if offset is None else offset.cast("double")).alias("offset")
    sized = docs.select(*_row_keys(), words(F.col("text")).alias("size"), prior)
    sized = written(
        sized.groupBy("source", "doc_id", "place").agg(
            F.max("size").alias("size"), F.max("offset").alias("offset"), F.count("*").alias("rows")
        ), "mix-sizes",
    )
    targets = source_targets(sized, weights, max_rate)
    solved = multipliers(sized, targets, max_rate)
    per_source = docs.sparkSession.createDataFrame(
        [(*target, solved[target[0]]) for target in targets],
        "source string, docs long, source_size long, target double, lambda double",
    )
    rated = sized.join(_few(per_source, len(targets)), sized.source.eqNullSafe(per_source.source)).select(
        sized["*"], "docs", "source_size", "target",
        F.least(F.exp(F.col("lambda") + F.col("offset")), F.lit(max_rate)).alias("rate"),
    )
    groups = F.ceil(F.col("docs") / F.lit(ROUNDED_TOGETHER)).cast("long")
    schema = (
        "doc_id long, source string, place long, size long, rows long, source_size long, target double, "
        "rate double, copies long, extra long"
    )
    wanted = [field.split()[0] for field in schema.split(", ")]
    units = rated.withColumn("part", F.pmod("place", groups)).groupBy("source", "part").applyInPandas(
        lambda group: _copies(group)[wanted], schema
    )
    return units, not sized.where("rows > 1").isEmpty()


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, offset: F.Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source, source_size, target, rate, copies, taken``.

    ``offset`` is the logarithm of a document's prior rate (0 by default: all documents alike).
    """
    units, _ = _rounded(docs, weights, max_rate, offset)
    each = units.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).withColumn(
        "copies", F.col("copies") + (F.col("row") <= F.col("extra")).cast("long")
    )
    return each.select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _extra_rows(keyed: DataFrame, units: DataFrame) -> DataFrame:
    """``given`` of the rows that get one copy more than the others of their document.

    Rows equal in all columns are counted, never told apart. Different ones are taken by a hash of their columns,
    in buckets, so that no task orders all rows of one document.
    """
    uneven = units.where("extra > 0").select("of", "extra")
    counted = keyed.join(uneven, keyed.key.eqNullSafe(uneven.of)).groupBy("key", "extra", "given").agg(
        F.count("*").alias("rows")
    )
    line = F.xxhash64(F.to_json("given"))
    counted = written(counted.withColumn("line", line).withColumn("bucket", F.pmod("line", F.lit(BUCKETS))), "mix-uneven")
    sums = counted.groupBy("key", "bucket").agg(F.sum("rows").alias("bucket_rows"))

    def before(rows: str, *by: str, order: list[str]) -> F.Column:
        above = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(above), F.lit(0))

    starts = sums.select(
        F.col("key").alias("of"), F.col("bucket").alias("at"), before("bucket_rows", "key", order=["bucket"]).alias("start")
    )
    placed = counted.withColumn("within", before("rows", "key", "bucket", order=["line", "given"])).join(
        starts, F.col("key").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
    )
    more = F.least(F.col("rows"), F.col("extra") - F.col("start") - F.col("within"))
    # In steps, so that no row holds a long array.
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.col("more") - 1, F.lit(4096).cast("long")))
    return placed.withColumn("more", more).where("more > 0").select("given", "more", steps.alias("step")).select(
        "given", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(4096), F.col("more") - F.col("step"))))
    ).select("given.*")


def mixed_rows(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, offset: F.Column | None = None,
) -> DataFrame:
    """The rows of ``docs``, each repeated as often as the mix takes it, with all their columns."""
    units, repeated = _rounded(docs, weights, max_rate, offset)
    units = units.select(F.struct("source", "doc_id", "place").alias("of"), "copies", "extra")
    keyed = docs.select(F.struct(*docs.columns).alias("given"), F.struct(*_row_keys()).alias("key"))
    if repeated:
        units = written(units, "mix-copies")
    copies = units.where("copies > 0").select("of", "copies")
    rows = keyed.join(copies, keyed.key.eqNullSafe(copies.of)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select("given.*")
    if not repeated:
        # Without repeated rows no document has an extra copy: a single row's copies are all its own.
        return rows
    return rows.unionByName(_extra_rows(keyed, units))
