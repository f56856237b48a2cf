"""Top rows per group and exact ranks over tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct metric values per block. A block is ranked by one task, which so never holds more rows.
BLOCK_VALUES = 1 << 20


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int, rank: str) -> DataFrame:
    """The first ``limit`` rows of each group. ``order`` must end in a unique column.

    Spark cuts each group to ``limit`` rows in every task before the shuffle, so a hot group moves
    no more rows than any other.
    """
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= limit)


def tally(df: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (``by``, metric value). Equal values are merged before the shuffle, so ties cost nothing."""
    return df.groupBy(*by, metric).agg(F.count("*").alias("_ties"))


def value_ranks(tallies: DataFrame, metric: str, rank: str, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Rank of every value of a whole-number metric within ``by``, and the group's size in ``_rows``.

    The distinct values are cut into blocks of adjacent values. A value's rank is one more than the
    rows in the blocks before its own and the rows before it in its own block; so no task sees more
    than the values of one block, or one line per block.
    """
    def ordered(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    placed = tallies.withColumn("_block", F.floor(F.col(metric) / BLOCK_VALUES))
    group = Window.partitionBy(*by)
    before = group.orderBy(ordered("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy(*by, "_block")
        .agg(F.sum("_ties").alias("_size"))
        .select(
            *by, "_block",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_ahead"),
            F.sum("_size").over(group).alias("_rows"),
        )
    )
    inside = Window.partitionBy(*by, "_block").orderBy(ordered(metric)).rowsBetween(Window.unboundedPreceding, -1)
    ahead_here = F.coalesce(F.sum("_ties").over(inside), F.lit(0)).alias("_ahead_here")
    return (
        placed.select("*", ahead_here)
        .join(blocks, [*by, "_block"])
        .select(*by, metric, (F.col("_ahead") + F.col("_ahead_here") + 1).alias(rank), "_rows")
    )


def with_ranks(
    df: DataFrame, population: DataFrame, metric: str, overall_rank: str, group: str, group_rank: str,
) -> DataFrame:
    """Add two competition ranks of a whole-number metric, highest first: over all rows and per group.

    ``population`` holds ``group`` and ``metric`` of the same rows, from as cheap a source as there is;
    it is only counted. Ties share a rank.
    """
    tallies = tally(population, metric, [group])
    everywhere = tallies.groupBy(metric).agg(F.sum("_ties").alias("_ties"))
    overall = value_ranks(everywhere, metric, overall_rank).drop("_rows")
    grouped = value_ranks(tallies, metric, group_rank, [group]).drop("_rows")
    return df.join(grouped.join(overall, metric), [group, metric])


def with_percent_rank(df: DataFrame, population: DataFrame, metric: str, percent_rank: str) -> DataFrame:
    """Add (rank - 1) / (rows - 1) of a whole-number metric, lowest first; 0 for a single row."""
    ranks = value_ranks(tally(population, metric), metric, "_rank", descending=False)
    scaled = ranks.select(
        metric,
        F.when(F.col("_rows") > 1, (F.col("_rank") - 1) / (F.col("_rows") - 1)).otherwise(0.0).alias(percent_rank),
    )
    return df.join(scaled, metric)
