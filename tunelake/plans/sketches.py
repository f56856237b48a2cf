"""Sketches that are kept by month and merged over any span, so that a span needs no second look at the fact.

Distinct counts cannot be added up, nor can ranks. A HyperLogLog sketch of the listeners and one of the tracks lie
beside the exact counts of each month and genre; a KLL sketch of the listeners' times lies beside each month. Merging
sketches gives the sketch of all rows together. Sketches are of bounded size, whatever they have seen, and are made
by partial aggregates before the shuffle, so hot genres and months cost no more than others.

Errors: a distinct count of ``n`` is within ``DISTINCT_ERROR * n`` and at least half a thing (three and more deviations
at 2^14 registers, 0.8 % each); a rank is within ``RANK_ERROR`` of the exact share of rows (k = 800, some 0.4 % at
99 %, and a step of 0.25 %). Small counts are exact in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.operators.ranking import with_percent_rank
from tunelake.plans.gold import Gold

REGISTER_BITS = 14
DISTINCT_ERROR = 0.03
KLL_K = 800
RANK_ERROR = 0.01
#: Shares of a sketch that ranks are read from.
STEPS = 400


# --- distinct counts ------------------------------------------------------------------------------------

def monthly_genre_sketches(gold: Gold) -> DataFrame:
    """``year, month, genre, stream_count, total_duration_ms, listeners, tracks``; the last two are sketches."""
    plays = gold.fact_streams.groupBy("date_key", "track_key", "listener_key").agg(
        F.count("*").alias("stream_count"), F.sum("duration_played_ms").alias("total_duration_ms")
    )
    day = F.col("date_key")
    return plays.join(gold.dim_track.select("track_key", "genre"), "track_key").groupBy(
        F.floor(day / 10000).cast("int").alias("year"), F.floor(day / 100 % 100).cast("int").alias("month"), "genre"
    ).agg(
        F.sum("stream_count").alias("stream_count"), F.sum("total_duration_ms").alias("total_duration_ms"),
        F.hll_sketch_agg("listener_key", REGISTER_BITS).alias("listeners"),
        F.hll_sketch_agg("track_key", REGISTER_BITS).alias("tracks"),
    )


def genre_uniques(sketches: DataFrame, *span: str) -> DataFrame:
    """Sums and estimated distinct listeners and tracks per ``span`` and genre, from monthly sketches alone."""
    return sketches.groupBy(*span, "genre").agg(
        F.sum("stream_count").alias("stream_count"), F.sum("total_duration_ms").alias("total_duration_ms"),
        F.hll_sketch_estimate(F.hll_union_agg("listeners")).alias("unique_listeners"),
        F.hll_sketch_estimate(F.hll_union_agg("tracks")).alias("unique_tracks"),
    )


def _near(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(0.5), exact * DISTINCT_ERROR)


def yearly_genre_uniques(gold: Gold, sketches: DataFrame | None = None) -> DataFrame:
    """Exact yearly distinct counts per genre, and whether those from the monthly sketches are within their error."""
    months = monthly_genre_sketches(gold) if sketches is None else sketches
    estimated = genre_uniques(months, "year").select(
        "year", "genre", "stream_count", F.col("unique_listeners").alias("_listeners"), F.col("unique_tracks").alias("_tracks")
    )
    year = F.floor(F.col("date_key") / 10000).cast("int").alias("year")
    plays = gold.fact_streams.select(year, "track_key", "listener_key").distinct().join(
        gold.dim_track.select("track_key", "genre"), "track_key"
    )
    exact = [
        plays.select("year", "genre", key).distinct().groupBy("year", "genre").agg(F.count("*").alias(name))
        for key, name in (("listener_key", "unique_listeners"), ("track_key", "unique_tracks"))
    ]
    both = exact[0].join(exact[1], ["year", "genre"]).join(estimated, ["year", "genre"])
    within = _near(F.col("_listeners"), F.col("unique_listeners")) & _near(F.col("_tracks"), F.col("unique_tracks"))
    return both.select("year", "genre", "stream_count", "unique_listeners", "unique_tracks", within.alias("within_error"))


# --- ranks ----------------------------------------------------------------------------------------------

def monthly_time_sketches(gold: Gold) -> DataFrame:
    """``year, month, listeners, times``: a sketch of the times that listeners played in a month, in milliseconds."""
    day = F.col("date_key")
    month = (F.floor(day / 10000).cast("int").alias("year"), F.floor(day / 100 % 100).cast("int").alias("month"))
    times = gold.agg_daily_listener_streams.groupBy(*month, "listener_key").agg(
        F.sum("total_duration_ms").alias("played_ms")
    )
    return times.groupBy("year", "month").agg(
        F.count("*").alias("listeners"), F.kll_sketch_agg_bigint("played_ms", KLL_K).alias("times")
    )


def time_quantiles(sketches: DataFrame, shares: list[float], *span: str) -> DataFrame:
    """The times below which the ``shares`` of listener-months of a span lie, from monthly sketches alone."""
    merged = sketches.groupBy(*span).agg(F.kll_merge_agg_bigint("times").alias("times"))
    return merged.select(
        *span, *(F.kll_sketch_get_quantile_bigint("times", F.lit(share)).alias(f"p{round(share * 100)}") for share in shares)
    )


def listening_percentiles(gold: Gold, buckets: int = 64) -> DataFrame:
    """``listener_key, played_ms, percentile``: the share of listeners who played less, estimated from a sketch.

    The sketch is merged from ``buckets`` of listeners, by a hash of their keys; exact ranks need a sort instead.
    """
    totals = gold.agg_daily_listener_streams.groupBy("listener_key").agg(F.sum("total_duration_ms").alias("played_ms"))
    parts = totals.groupBy(F.pmod(F.xxhash64("listener_key"), F.lit(buckets)).alias("bucket")).agg(
        F.kll_sketch_agg_bigint("played_ms", KLL_K).alias("times"), F.count("*").alias("listeners")
    )
    # The times at evenly spaced shares; how many of them a listener reaches is their rank.
    shares = F.array(*(F.lit(step / STEPS) for step in range(1, STEPS + 1)))
    whole = parts.agg(F.kll_merge_agg_bigint("times").alias("times"), F.sum("listeners").alias("listeners")).select(
        F.kll_sketch_get_quantile_bigint("times", shares).alias("steps"), "listeners"
    )
    ranked = totals.withColumns({name: whole.select(name).scalar() for name in whole.columns})
    share = F.size(F.filter("steps", lambda time: time <= F.col("played_ms"))) / STEPS
    # The sketch counts a listener's own row; a percentile is of the others.
    own = F.col("listeners")
    percentile = F.when(own > 1, F.greatest(F.lit(0.0), (share * own - 1) / (own - 1))).otherwise(0.0)
    return ranked.select("listener_key", "played_ms", percentile.alias("percentile"))


def percentiles_checked(gold: Gold) -> DataFrame:
    """Every listener's exact percentile, and whether the one from the sketch is within its error."""
    estimated = listening_percentiles(gold)
    exact = with_percent_rank(estimated, estimated.select("played_ms"), "played_ms", "_exact")
    # Listeners with equal times share a rank in the one and the highest place in the other.
    ties = estimated.groupBy("played_ms").agg(F.count("*").alias("_ties"))
    others = F.greatest(F.lit(1), estimated.agg(F.count("*").alias("listeners")).scalar() - 1)
    slack = RANK_ERROR + (F.col("_ties") - 1) / others
    names = gold.dim_listener.select("listener_key", "listener_id")
    return exact.join(ties, "played_ms").join(names, "listener_key").select(
        "listener_id", F.round(F.col("_exact") * 100, 0).alias("listening_percentile"),
        (F.abs(F.col("percentile") - F.col("_exact")) <= slack).alias("within_error"),
    )
