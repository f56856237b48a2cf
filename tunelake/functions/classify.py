"""Classifications by thresholds. The bounds and labels below are fixed values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunelake.functions import numbers

# Upper bounds, exclusive.
AGE_GROUPS = [(18, "Under 18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
OLDEST_GROUP = "55+"
UNKNOWN_AGE = "Unknown"
POPULARITY_TIERS = [(10_000, "emerging"), (100_000, "established"), (1_000_000, "star")]
TOP_TIER = "superstar"
# "short" ends before the first bound, "medium" includes the second.
SHORT_TRACK_MS = 180_000
MEDIUM_TRACK_MS = 300_000
FULL_PLAY_PERCENT = 90.0
# First and last hour, both included; every other hour is "Late Night".
HOUR_BANDS = [
    (5, 8, "Early Morning"), (9, 11, "Morning"), (12, 14, "Midday"),
    (15, 17, "Afternoon"), (18, 20, "Evening"), (21, 23, "Night"),
]
REMAINING_HOURS = "Late Night"
DEVICE_CATEGORIES = [
    ("mobile", "mobile"), ("tablet", "mobile"), ("desktop", "desktop"), ("web", "desktop"),
    ("smart_speaker", "other"),
]


def first_match(cases: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first condition that holds."""
    return F.coalesce(*(F.when(condition, F.lit(label)) for condition, label in cases), F.lit(otherwise))


def age_group(years: Column) -> Column:
    return first_match(
        [(years.isNull(), UNKNOWN_AGE)] + [(years < bound, label) for bound, label in AGE_GROUPS], OLDEST_GROUP
    )


def popularity_tier(monthly_listeners: Column) -> Column:
    return first_match([(monthly_listeners < bound, label) for bound, label in POPULARITY_TIERS], TOP_TIER)


def duration_bucket(duration_ms: Column) -> Column:
    return first_match([(duration_ms < SHORT_TRACK_MS, "short"), (duration_ms <= MEDIUM_TRACK_MS, "medium")], "long")


def time_of_day(moment: Column) -> Column:
    hour = F.hour(moment)
    return first_match([(hour.between(first, last), label) for first, last, label in HOUR_BANDS], REMAINING_HOURS)


@dataclass(frozen=True)
class PersonalityRules:
    """Thresholds of the listening personalities; the first rule that holds wins."""

    explorer_artists: int = 80
    loyalist_genres: int = 3
    shuffle_share: float = 0.7
    full_play_share: float = 0.85
    offline_share: float = 0.5
    power_streams: int = 2500


def personality(
    streams: Column, artists: Column, genres: Column, shuffled: Column, full_plays: Column, offline: Column,
    rules: PersonalityRules,
) -> Column:
    return first_match(
        [
            (artists >= rules.explorer_artists, "Explorer"),
            (genres <= rules.loyalist_genres, "Genre Loyalist"),
            (numbers.share(shuffled, streams) > rules.shuffle_share, "The Shuffler"),
            (numbers.share(full_plays, streams) > rules.full_play_share, "Deep Listener"),
            (numbers.share(offline, streams) > rules.offline_share, "Offline Adventurer"),
            (streams > rules.power_streams, "Power User"),
        ],
        "Casual Listener",
    )


# A weekend stream weighs this many times a weekday stream (5 weekdays to 2 weekend days).
WEEKEND_WEIGHT = 2.5
WEEKDAYS_PER_YEAR = 52 * 5
WEEKEND_DAYS_PER_YEAR = 52 * 2


def week_habit(weekday_streams: Column, weekend_streams: Column) -> Column:
    return first_match([(weekend_streams * WEEKEND_WEIGHT > weekday_streams, "Weekend Warrior")], "Weekday Listener")
