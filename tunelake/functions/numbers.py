"""Ratios, rounding and unit changes.

Measures are summed as whole numbers (milliseconds, hundredths of a percent) and divided once at
the end, so a result does not depend on how the rows were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_SECOND = 1000.0
MS_PER_MINUTE = 60_000.0
MS_PER_HOUR = 3_600_000.0


def in_seconds(ms: Column, digits: int = 1) -> Column:
    return F.round(ms / F.lit(MS_PER_SECOND), digits)


def in_minutes(ms: Column, digits: int = 1) -> Column:
    return F.round(ms / F.lit(MS_PER_MINUTE), digits)


def in_hours(ms: Column, digits: int = 1) -> Column:
    return F.round(ms / F.lit(MS_PER_HOUR), digits)


def share(part: Column, whole: Column) -> Column:
    """Unrounded part of the whole, 0 to 1."""
    return part.cast("double") / whole


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(part * F.lit(100.0) / whole, digits)


def played_percent(played_ms: Column, track_ms: Column) -> Column:
    """Unrounded share of a track that was played, or null for a track without a length."""
    return F.when(track_ms > 0, played_ms * F.lit(100.0) / track_ms)


def completion_points(pct: Column) -> Column:
    """A percentage kept to two digits, as whole hundredths."""
    return F.round(pct * 100).cast("bigint")


def mean_completion(points: Column, rows: Column, digits: int = 1) -> Column:
    """Average percentage from summed hundredths."""
    return F.round(points / (rows * F.lit(100.0)), digits)
