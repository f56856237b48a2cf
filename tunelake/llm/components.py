"""Connected components of links between whole numbers, by alternating large and small stars.

Every step is a grouped minimum and a join on the node; a node with very many links is merged before the shuffle
and, in the join, left to Spark's splitting of hot partitions. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; the larger node of a link is ``a``."""
    lowest = links.groupBy("a").agg(F.min("b").alias("m"))
    neighbours = links.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return neighbours.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; the root is the smallest node of the component."""
    links = links.where("a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    ).distinct()
    state, before = written(links, "links"), None
    while True:
        now = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(b)")).first()
        if now == before or not now[0]:
            break
        before = now
        state = written(_small_star(_large_star(state)), "links")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes (node, root)`` with further ``links (a, b)``; only the roots they join are gone through again."""
    def root_of(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))

    between = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
    )
    joined = components(between)
    moved = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
    changed = classes.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return changed.unionByName(joined.join(classes.select("node"), "node", "left_anti"))
