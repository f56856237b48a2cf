"""Copies of records and repeated keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_copies(df: DataFrame, content: Sequence[str], hash_column: str = "_row_hash") -> DataFrame:
    """One row per record content.

    Rows with the same hash agree on their content, so keeping any of them is the same as keeping the
    first. Grouping by hash and content needs no aggregate buffer: copies are merged by a hash
    aggregate before the shuffle, and a record repeated any number of times leaves each task once.
    """
    return df.select(*content, hash_column).distinct().drop(hash_column)


def repeated_hashes(df: DataFrame, hash_column: str = "_row_hash") -> DataFrame:
    """Hashes that occur more than once, with their number of rows."""
    return (
        df.groupBy(hash_column)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values carried by more than one row; counted before the shuffle, so a hot key costs nothing."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1").select(key)


def with_shared_keys(df: DataFrame, repeated: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``_shared_<key>``: true where the row's key is among the ``repeated`` ones, else null.

    The joins are left to Spark, which broadcasts the repeated keys when there are few, so that the
    rows stay where they are, and splits the partition of a hot key when there are many.
    """
    for key, values in repeated.items():
        df = df.join(values.select(key, F.lit(True).alias(f"_shared_{key}")), key, "left")
    return df
