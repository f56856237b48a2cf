"""Additive roll-ups of the fact: the first step of every view that counts distinct things.

Rolling up to (listener, track) merges repeated plays before the first shuffle. Distinct tracks are
then a plain row count, dimension lookups join the roll-up instead of the fact, and a hot listener or
track is spread over as many groups as it has partners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions import numbers

# Rolled-up measures; all of them can be added again.
MEASURES = ["streams", "played_ms", "points", "full_plays", "shuffled", "offline"]


def roll_up(fact: DataFrame, *keys: str | Column, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Sum the fact's measures per key combination."""
    return fact.groupBy(*keys).agg(
        F.count("*").alias("streams"),
        F.sum("duration_played_ms").alias("played_ms"),
        F.sum(numbers.completion_points(F.col("duration_played_pct"))).alias("points"),
        F.sum("is_full_play").alias("full_plays"),
        F.sum("shuffle_mode").alias("shuffled"),
        F.sum("offline_mode").alias("offline"),
        *extra,
    )


def summed() -> list[Column]:
    """Aggregates that add the measures of an earlier roll-up."""
    return [F.sum(measure).alias(measure) for measure in MEASURES]
