from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tunelake.operators import frequent
from tunelake.operators.frequent import frequent_keys


def rows(spark, hot, rare):
    """``hot`` keys with many rows each, the more the smaller the key, and ``rare`` ones with one row."""
    many = spark.range(hot).select("id", F.explode(F.sequence(F.lit(0), 400 - 3 * F.col("id"))).alias("n"))
    few = spark.range(1000, 1000 + rare).select("id", F.lit(0).cast("long").alias("n"))
    keyed = many.unionByName(few).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"), F.lit("x").alias("_hash_of"))
    return keyed.repartition(5)


def plain(df, limit):
    found = df.groupBy("a", "b").agg(F.count("*").alias("plays")).orderBy(F.desc("plays"), "a", "b").limit(limit)
    return [tuple(r) for r in found.collect()]


def first(found, limit):
    return [tuple(r) for r in found.orderBy(F.desc("plays"), "a", "b").limit(limit).collect()]


def test_only_candidates_are_counted_and_none_is_missing(spark):
    given = rows(spark, 30, 20_000)
    found = frequent_keys(given, ["a", "b"], 10, "plays", tracked=1000)
    assert "LeftSemi" in plan_of(found) and found.count() <= 1000
    assert first(found, 10) == plain(given, 10)


def test_all_keys_are_counted_where_nothing_is_proven(spark):
    given = rows(spark, 0, 5000)
    found = frequent_keys(given, ["a", "b"], 10, "plays", tracked=100)
    assert "LeftSemi" not in plan_of(found) and found.count() == 5000


def test_few_keys_ties_nulls_and_no_rows(spark):
    given = spark.createDataFrame([(1, None), (1, None), (None, 2), (3, 4), (3, 4)], "a long, b long")
    found = frequent_keys(given, ["a", "b"], 2, "plays")
    assert {tuple(r) for r in found.collect()} == {(1, None, 2), (None, 2, 1), (3, 4, 2)}
    assert frequent_keys(given.limit(0), ["a", "b"], 2, "plays").collect() == []
    assert frequent._table_size(1000) == 2048 and frequent._table_size(96) == 128
