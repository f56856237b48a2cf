"""Cleaning of text columns. All of these are plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text the loaders write for a missing value (fixed value).
MISSING_TOKEN = "None"
# Spellings that count as true, after trimming and lower-casing (fixed values).
TRUE_SPELLINGS = ["true", "1"]


def present(value: Column) -> Column:
    """True where a value is there and is not the missing-value token."""
    return value.isNotNull() & (value != MISSING_TOKEN)


def known_text(value: Column) -> Column:
    """Trimmed text, or null where it is missing, blank or the missing-value token."""
    trimmed = F.trim(value)
    return F.when(present(value) & (trimmed != ""), trimmed)


def capitalised(value: Column) -> Column:
    """First letter upper, all others lower: ``hip hop`` gives ``Hip hop``, not ``Hip Hop``."""
    trimmed = F.trim(value)
    return F.concat(F.upper(F.substring(trimmed, 1, 1)), F.lower(F.substr(trimmed, F.lit(2))))


def flag(value: Column) -> Column:
    """1 for any spelling of true, else 0; missing counts as 0."""
    return F.when(F.lower(F.trim(value)).isin(TRUE_SPELLINGS), 1).otherwise(0)


def whole_number(value: Column) -> Column:
    """The text as a whole number, or null where it is not one."""
    return F.trim(value).try_cast("bigint")


def labelled(prefix: str, value: Column) -> Column:
    """A reason text that stays readable when the value is missing."""
    return F.concat(F.lit(prefix), F.coalesce(value, F.lit("<null>")))
