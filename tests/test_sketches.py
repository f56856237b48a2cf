import re

from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tunelake.plans import serving, sketches


def test_a_year_from_monthly_sketches_reads_no_fact(spark, gold, tmp_path):
    months = sketches.monthly_genre_sketches(gold)
    months.write.parquet(str(tmp_path / "months"))
    kept = spark.read.parquet(str(tmp_path / "months"))
    yearly = sketches.genre_uniques(kept, "year")
    assert "date_key" not in plan_of(yearly)
    exact = gold.fact_streams.join(gold.dim_track, "track_key").groupBy("genre").agg(
        F.countDistinct("listener_key").alias("l"), F.countDistinct("track_key").alias("t"), F.count("*").alias("n")
    )
    wanted = {r.genre: (r.l, r.t, r.n) for r in exact.collect()}
    assert {r.genre: (r.unique_listeners, r.unique_tracks, r.stream_count) for r in yearly.collect()} == wanted
    assert all(r.within_error for r in sketches.yearly_genre_uniques(gold, kept).collect())


def test_errors_of_large_counts_and_ranks(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 12).alias("month"), (F.xxhash64("id") % 9000).alias("key"), (F.xxhash64("id", F.lit(1)) % 100_000).alias("ms")
    )
    parts = rows.groupBy("month").agg(
        F.hll_sketch_agg("key", sketches.REGISTER_BITS).alias("keys"), F.kll_sketch_agg_bigint("ms", sketches.KLL_K).alias("times")
    )
    estimate = parts.agg(F.hll_sketch_estimate(F.hll_union_agg("keys"))).first()[0]
    exact = rows.select("key").distinct().count()
    assert 0 < abs(estimate - exact) <= sketches.DISTINCT_ERROR * exact
    found = sketches.time_quantiles(parts.withColumn("year", F.lit(1)), [0.1, 0.5, 0.9], "year").first()
    for share, value in ((0.1, found.p10), (0.5, found.p50), (0.9, found.p90)):
        below = rows.where(F.col("ms") <= value).count() / 40_000
        assert abs(below - share) <= sketches.RANK_ERROR


def test_percentiles_are_within_their_error(gold):
    rows = sketches.percentiles_checked(gold).collect()
    exact = {r.listener_id: r.listening_percentile for r in serving.year_in_review_summary(gold).collect()}
    assert {r.listener_id: r.listening_percentile for r in rows} == exact and all(r.within_error for r in rows)


def test_no_view_multiplies_rows_for_distinct_counts(gold):
    for name in ("v_listener_summary", "v_listening_personality", "v_year_in_review_summary"):
        assert not re.search(r"\bExpand\b", plan_of(serving.VIEWS[name](gold)))
