"""The most frequent keys of a table without counting all keys.

A frequent-items sketch, made by partial aggregates and merged, tracks a bounded number of keys; the rows of these
candidates alone are then counted exactly. A key that the sketch does not track has at most ``ERROR * rows / size``
rows, so a list whose last entry has more is proven complete. Where that cannot be proven, all keys are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys tracked by a sketch (some 16 bytes each); as many are brought to the driver and broadcast.
TRACKED = 100_000
#: Untracked rows of a key are at most this share of all rows, over the size of the sketch's table.
ERROR = 3.5


def _table_size(tracked: int) -> int:
    """The power of two that holds the tracked keys at three quarters full."""
    return 1 << (-(-4 * tracked // 3) - 1).bit_length()


def frequent_keys(df: DataFrame, keys: Sequence[str], limit: int, count: str, tracked: int = TRACKED) -> DataFrame:
    """``keys, count`` of at least the ``limit`` most frequent keys and all that tie with the last of them.

    Keys are tracked by a 64-bit hash; keys that share one are candidates together, as rows are counted by the keys.
    """
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    seen = hashed.agg(
        F.count("*").alias("rows"),
        F.expr(f"approx_top_k_estimate(approx_top_k_accumulate(_hash, {tracked}), {tracked})").alias("items"),
    ).first()
    items = seen["items"] or []
    everything = df.groupBy(*keys).agg(F.count("*").alias(count))
    if not items:
        return everything
    candidates = df.sparkSession.createDataFrame([(item["item"],) for item in items], "_hash long")
    counted = hashed.join(F.broadcast(candidates), "_hash", "left_semi").groupBy(*keys).agg(F.count("*").alias(count))
    if sum(item["count"] for item in items) == seen["rows"]:
        return counted  # no key was ever dropped
    last = counted.orderBy(F.desc(count)).limit(limit).select(count).collect()
    proven = len(last) == limit and min(row[0] for row in last) > ERROR * seen["rows"] / _table_size(tracked)
    return counted if proven else everything
