"""Documented ad-hoc questions over the layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.functions import numbers
from tunelake.operators.frequent import frequent_keys
from tunelake.operators.rollups import roll_up
from tunelake.plans import serving
from tunelake.plans.bronze import Bronze
from tunelake.plans.gold import Gold
from tunelake.plans.silver import Silver


def top_genre_per_month(gold: Gold) -> DataFrame:
    """The most played genres of each month (several when tied). The calendar is cut to one line per
    month first, so that a month is not repeated for each of its days."""
    monthly = gold.agg_monthly_genre_streams
    best = monthly.groupBy("year", "month").agg(F.max("stream_count").alias("stream_count"))
    months = gold.dim_date.select("year", "month", "month_name").distinct()
    return (
        monthly.join(best, ["year", "month", "stream_count"], "left_semi")
        .join(F.broadcast(months), ["year", "month"])
        .select("year", "month", "month_name", "genre", "stream_count")
    )


def top_listeners(gold: Gold, limit: int = 10) -> DataFrame:
    """Listeners by minutes played; ties by id."""
    played = gold.fact_streams.groupBy("listener_key").agg(F.sum("duration_played_ms").alias("played_ms"))
    named = played.join(gold.dim_listener.select("listener_key", "listener_id", "full_name"), "listener_key")
    return (
        named.orderBy(F.desc("played_ms"), F.asc("listener_id")).limit(limit)
        .select("listener_id", "full_name", (F.col("played_ms") / numbers.MS_PER_MINUTE).alias("total_minutes"))
    )


def plays_by_age_group(gold: Gold) -> DataFrame:
    """Plays per age group and their share of all plays."""
    per_listener = gold.fact_streams.groupBy("listener_key").agg(F.count("*").alias("plays"))
    grouped = (
        per_listener.join(gold.dim_listener.select("listener_key", "age_group"), "listener_key")
        .groupBy("age_group")
        .agg(F.sum("plays").alias("streams"))
    )
    total = F.sum("streams").over(Window.partitionBy())  # over a row per age group
    return grouped.select("age_group", "streams", numbers.percent(F.col("streams"), total).alias("pct"))


def completion_by_day_type(gold: Gold) -> DataFrame:
    """Plays and average completion on weekdays and weekends."""
    day_type = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_type")
    days = F.broadcast(gold.dim_date.select("date_key", "is_weekend"))
    rolled = roll_up(gold.fact_streams.join(days, "date_key"), day_type)
    return rolled.select(
        "day_type", "streams", numbers.mean_completion(F.col("points"), F.col("streams")).alias("avg_completion")
    )


def top_listener_artists(gold: Gold, limit: int = 10) -> DataFrame:
    """The (listener, artist) pairs with most plays; ties by ids. Only pairs that may be among them are counted."""
    plays = gold.fact_streams.select("listener_key", "track_key").join(
        gold.dim_track.select("track_key", "artist_key"), "track_key"
    )
    per_artist = frequent_keys(plays, ["listener_key", "artist_key"], limit, "plays")
    return (
        per_artist.join(gold.dim_listener.select("listener_key", "listener_id", "full_name"), "listener_key")
        .join(gold.dim_artist.select("artist_key", "artist_id", F.col("name").alias("artist")), "artist_key")
        .orderBy(F.desc("plays"), F.asc("listener_id"), F.asc("artist_id"))
        .limit(limit)
        .select("listener_id", "full_name", "artist_id", "artist", "plays")
    )


def genres_before_and_after(bronze: Bronze, silver: Silver) -> DataFrame:
    """Artist genres as loaded and as cleaned."""
    def counted(layer: str, artists: DataFrame) -> DataFrame:
        return artists.groupBy("genre").agg(F.count("*").alias("artists")).select(
            F.lit(layer).alias("layer"), "genre", "artists"
        )

    return counted("bronze", bronze.artists).unionByName(counted("silver", silver.artists))


def lineage(bronze: Bronze) -> DataFrame:
    """Stream records per source file and load."""
    return bronze.streams.groupBy("_source_file", "_loaded_at").agg(F.count("*").alias("records"))


def raw_time_range(bronze: Bronze) -> DataFrame:
    return bronze.streams.agg(
        F.min("streamed_at").alias("first_streamed_at"), F.max("streamed_at").alias("last_streamed_at")
    )


def raw_mode_values(bronze: Bronze) -> DataFrame:
    return bronze.streams.select("shuffle_mode", "offline_mode").distinct()


def source_files(bronze: Bronze) -> DataFrame:
    return bronze.streams.select("_source_file").distinct()


def column_types(silver: Silver, table: str) -> DataFrame:
    """Type of every column of a table and how many rows hold a value in it."""
    df = getattr(silver, table)
    filled = df.agg(*(F.count(name).alias(name) for name in df.columns))
    lines = [
        F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("type"),
                 F.col(field.name).alias("filled"))
        for field in df.schema.fields
    ]
    return filled.select(F.inline(F.array(*lines)))


def values_per_group(dimension: DataFrame, column: str) -> DataFrame:
    """Rows of a dimension per value of one of its derived columns."""
    return dimension.groupBy(column).agg(F.count("*").alias("members"))


# --- questions to the views --------------------------------------------------------------------------

def longest_listening(gold: Gold, limit: int = 10) -> DataFrame:
    return (
        serving.year_in_review_summary(gold)
        .orderBy(F.desc("total_hours"), F.asc("listener_id"))
        .limit(limit)
        .select("listener_id", "listener_name", "total_hours", "unique_artists", "listening_percentile")
    )


def trends_of_genres(gold: Gold, genres: Sequence[str]) -> DataFrame:
    return (
        serving.genre_trends(gold)
        .where(F.col("genre").isin(list(genres)))
        .select("year", "month", "month_name", "genre", "stream_count", "month_share_pct")
    )


def listeners_with_personality(gold: Gold, personality: str, **options) -> DataFrame:
    return (
        serving.listening_personality(gold, **options)
        .where(F.col("listening_personality") == personality)
        .select("listener_id", "listener_name", "unique_artists", "unique_genres", "total_streams")
    )


def discovery_by_quarter(gold: Gold) -> DataFrame:
    columns = [f"q{quarter}_new_artists" for quarter in range(1, 5)]
    return serving.discovery_stats(gold).select("listener_id", "listener_name", "total_artists_played", *columns)
