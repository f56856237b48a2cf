"""Keep or reject rows by whether a key exists elsewhere.

None of the joins carries a broadcast hint: Spark broadcasts the key list when its known or measured
size is below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both sides and splits
the partitions of hot keys. ``by_shuffle`` takes that choice from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def by_shuffle(df: DataFrame) -> DataFrame:
    """A table that grows with the input, as one side of a join: both sides are shuffled, whatever its size.

    Spark goes by the size of the files, which hold text in a tenth of the memory that it takes when broadcast; and a
    join that is a broadcast at one size and a shuffle at the next grows faster than the input between them.
    """
    return df.hint("merge")


def having_key(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)), on, "left_semi")


def lacking_key(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``; a missing key is never in it."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)), on, "left_anti")
