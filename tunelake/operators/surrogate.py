"""Dense surrogate keys for dimensions of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the bucket: 16 ** 3 = 4096 buckets, so the table of bucket offsets is never larger. The bucket is a whole
# number, as a broadcast by text takes a whole page of memory for any number of rows.
BUCKET_DIGITS = 3


def with_dense_key(df: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Number the rows 1..n in the order (bucket, natural key); ``natural_key`` must be unique.

    The bucket is taken from a hash of the natural key, so rows spread evenly and the numbers depend
    on the data alone, not on its partitioning. Each bucket is numbered on its own and shifted by the
    size of the buckets before it; the only window over everything runs on at most 4096 bucket counts.
    """
    digits = F.substring(F.md5(F.col(natural_key)), 1, BUCKET_DIGITS)
    bucketed = df.withColumn("_bucket", F.conv(digits, 16, 10).cast("int"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, F.col("_offset") + F.col("_position"))
        .drop("_bucket", "_offset", "_position")
    )
