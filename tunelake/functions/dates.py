"""Dates, times and calendar fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A calendar date, alone or followed by a time of day.
_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}([ T]+\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?[ ]*$"
_PLAIN_SHAPE = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?)?$"
# Hour, minute, second, sign of the offset, its hours and minutes.
_TIME_PARTS = r"^.{10}[ T]+(\d{2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?(?:Z|([+-])(\d{2}):(\d{2}))?[ ]*$"
# Holidays that fall on the same day each year, as month-day (fixed values).
FIXED_HOLIDAYS = ["01-01", "07-04", "11-11", "12-25"]
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.44


def _digits(part: Column) -> Column:
    """A part of digits as a number; 0 where it is empty, as a cast that fails costs more than all the rest."""
    return F.concat(F.lit("0"), part).try_cast("int")


def _days(text: Column) -> tuple[Column, Column]:
    """Days since 1970 of the date that a text begins with, and whether month and day are numbers of the calendar."""
    year, month, day = (
        F.substring(text, start, length).try_cast("int") for start, length in ((1, 4), (6, 2), (9, 2))
    )
    days = F.unix_date(F.date_add(F.make_date(year, month, F.lit(1)), day - 1)).cast("long")
    return days, month.between(1, 12) & day.between(1, 31)


def _plain_seconds(text: Column) -> Column:
    """The same as below of a text in the one shape that nearly all have, from fixed places."""
    hour, minute, second = (_digits(F.substring(text, start, 2)) for start in (12, 15, 18))
    days, usable = _days(text)
    usable &= (hour < 24) & (minute < 60) & (second < 60)
    return F.when(usable, days * 86400 + hour * 3600 + minute * 60 + second)


def _any_seconds(text: Column) -> Column:
    def part(group: int) -> Column:
        """A group of digits of the time or the offset; 0 where it is not there."""
        return _digits(F.regexp_extract(text, _TIME_PARTS, group))

    hour, minute, second, offset_hour, offset_minute = (part(group) for group in (1, 2, 3, 5, 6))
    ahead = F.when(F.regexp_extract(text, _TIME_PARTS, 4) == "-", -1).otherwise(1)
    days, usable = _days(text)
    usable &= (hour < 24) & (minute < 60) & (second < 60) & (offset_hour < 24) & (offset_minute < 60)
    of_day = hour * 3600 + minute * 60 + second - ahead * (offset_hour * 3600 + offset_minute * 60)
    return F.when(usable, days * 86400 + of_day)


def _utc_seconds(text: Column) -> Column:
    """Seconds since 1970 of a date with or without a time of day and an offset; null for any other text.

    A day past the end of its month runs into the next one. Without an offset the time is taken as UTC. Only a text
    that is not in the plain shape is searched for its parts.
    """
    plain, dated = text.rlike(_PLAIN_SHAPE), text.rlike(_DATE_SHAPE)
    return F.when(plain, _plain_seconds(text)).when(dated, _any_seconds(text))


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD…`` as the UTC date, else null. A day past the end of its month runs into the next one."""
    return F.date_from_unix_date(F.floor(_utc_seconds(text) / 86400).cast("int"))


def mixed_date(text: Column) -> Column:
    """``YYYY-MM-DD`` or ``MM/DD/YYYY`` as a date, else null."""
    rearranged = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2))
    return iso_date(F.when(text.like("__/__/____"), rearranged).otherwise(text))


def event_time(text: Column) -> Column:
    """An ISO date, with or without a time of day, as a timestamp cut to whole seconds, or null.

    The same shapes are read as for dates, and the same days run into the next month.
    """
    return F.timestamp_seconds(_utc_seconds(text))


def date_key(moment: Column) -> Column:
    """The day as the whole number YYYYMMDD."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def sunday_based_weekday(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def monday_week_number(day: Column) -> Column:
    """Weeks start on Monday; the days before the year's first Monday are week 1. Not the ISO week."""
    days_since_monday = F.pmod(F.dayofweek(day) + 5, F.lit(7))
    return F.floor((F.dayofyear(day) + 6 - days_since_monday) / 7).cast("int") + 1


def is_weekend(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def is_fixed_holiday(day: Column) -> Column:
    return F.when(F.date_format(day, "MM-dd").isin(FIXED_HOLIDAYS), 1).otherwise(0)


def age_in_years(birth_date: Column, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), birth_date) / F.lit(DAYS_PER_YEAR)


def months_until(moment: Column, as_of: str) -> Column:
    """Whole average-length months from a moment to the start of a day, cut towards zero."""
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(moment)
    return (seconds / F.lit(86400.0) / F.lit(DAYS_PER_MONTH)).cast("int")
