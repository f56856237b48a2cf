"""Declared schema of every layer. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Declared fields of the raw files, in file order (fixed values).
RAW_FIELDS = {
    "listeners": [
        "listener_id", "email", "username", "first_name", "last_name",
        "birth_date", "city", "country", "subscription_type", "created_at",
    ],
    "artists": ["artist_id", "name", "genre", "country", "formed_year", "monthly_listeners"],
    "tracks": [
        "track_id", "title", "artist_id", "album", "duration_ms", "genre", "release_date", "explicit",
    ],
    "streams": [
        "stream_id", "listener_id", "track_id", "streamed_at", "duration_played_ms",
        "device_type", "shuffle_mode", "offline_mode",
    ],
}
AUDIT_FIELDS = ["_source_file", "_loaded_at", "_row_hash"]

BRONZE = {
    name: ", ".join(f"{field} string" for field in fields + AUDIT_FIELDS)
    for name, fields in RAW_FIELDS.items()
}

SILVER = {
    "listeners": (
        "listener_id string, email string, username string, first_name string, last_name string, "
        "birth_date date, city string, country string, subscription_type string, created_at timestamp"
    ),
    "artists": (
        "artist_id string, name string, genre string, country string, formed_year int, "
        "monthly_listeners bigint"
    ),
    "tracks": (
        "track_id string, title string, artist_id string, album string, duration_ms bigint, "
        "genre string, release_date date, explicit int"
    ),
    "streams": (
        "stream_id string, listener_id string, track_id string, streamed_at timestamp, "
        "duration_played_ms bigint, device_type string, shuffle_mode int, offline_mode int"
    ),
    "rejected_records": (
        "id bigint, source_table string, source_id string, rejection_reason string, rejected_at timestamp"
    ),
}

GOLD = {
    "dim_date": (
        "date_key int, full_date date, year int, quarter int, month int, month_name string, "
        "week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend int, is_holiday int"
    ),
    "dim_device": "device_key bigint, device_type string, device_category string",
    "dim_artist": (
        "artist_key bigint, artist_id string, name string, genre string, country string, formed_year int, "
        "years_active int, monthly_listeners bigint, popularity_tier string"
    ),
    "dim_listener": (
        "listener_key bigint, listener_id string, email string, username string, full_name string, "
        "birth_date date, age_group string, city string, country string, subscription_type string, "
        "created_at timestamp, tenure_months int"
    ),
    "dim_track": (
        "track_key bigint, track_id string, title string, artist_key bigint, album string, duration_ms bigint, "
        "duration_bucket string, genre string, release_date date, release_year int, explicit int"
    ),
    "fact_streams": (
        "stream_key bigint, date_key int, listener_key bigint, track_key bigint, device_key bigint, "
        "stream_id string, streamed_at timestamp, duration_played_ms bigint, duration_played_pct double, "
        "shuffle_mode int, offline_mode int, is_full_play int"
    ),
    "agg_daily_listener_streams": (
        "date_key int, listener_key bigint, stream_count bigint, total_duration_ms bigint, unique_tracks bigint, "
        "unique_artists bigint, shuffle_streams bigint, offline_streams bigint, full_plays bigint"
    ),
    "agg_daily_track_streams": (
        "date_key int, track_key bigint, stream_count bigint, unique_listeners bigint, "
        "total_duration_ms bigint, full_plays bigint"
    ),
    "agg_monthly_genre_streams": (
        "year int, month int, genre string, stream_count bigint, unique_listeners bigint, "
        "unique_tracks bigint, total_duration_ms bigint"
    ),
}

LISTENER_TRACKS = (
    "listener_key bigint, track_key bigint, artist_key bigint, genre string, streams bigint, played_ms bigint, "
    "points bigint, full_plays bigint, shuffled bigint, offline bigint, first_heard timestamp"
)


def names_of(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` onto a declared schema: its columns, their order and their types."""
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in (f.split() for f in ddl.split(", "))))
