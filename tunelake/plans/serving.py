"""Serving layer: fifteen views over the gold star, each a function from the star to a lazy frame.

Shape shared by the views: roll the fact up to the keys that matter, look up the dimension columns the
grouping needs on that roll-up, group again, rank, and only then fetch names and other descriptions.
Wide text columns so never travel through the large shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.functions import classify, numbers
from tunelake.operators.ranking import top_per_group, with_percent_rank, with_ranks
from tunelake.operators.rollups import roll_up, summed
from tunelake.plans.gold import Gold

TOP_ROWS = 5
TOP_TIMES = 3


# --- building blocks -------------------------------------------------------------------------------

def _days(gold: Gold, *columns: str) -> DataFrame:
    """The calendar, a line per day, broadcast."""
    return F.broadcast(gold.dim_date.select("date_key", *columns))


def _listener_names(gold: Gold, *columns: str) -> DataFrame:
    return gold.dim_listener.select("listener_key", "listener_id", F.col("full_name").alias("listener_name"), *columns)


def _track_plays(gold: Gold, *columns: str) -> DataFrame:
    """Plays per track from the daily aggregate, which is far smaller than the fact."""
    plays = gold.agg_daily_track_streams.groupBy("track_key").agg(F.sum("stream_count").alias("streams"))
    return plays.join(gold.dim_track.select("track_key", *columns), "track_key")


def _listener_totals(gold: Gold) -> DataFrame:
    """Measures and distinct tracks, artists and genres per listener.

    Each distinct count is a row count after a grouping by (listener, thing); two at once would double the rows.
    """
    by_artist = gold.listener_tracks.groupBy("listener_key", "artist_key").agg(
        *summed(), F.count("*").alias("unique_tracks")
    )
    totals = by_artist.groupBy("listener_key").agg(
        *summed(), F.sum("unique_tracks").alias("unique_tracks"), F.count("*").alias("unique_artists")
    )
    genres = gold.listener_tracks.select("listener_key", "genre").distinct().groupBy("listener_key").agg(
        F.count("genre").alias("unique_genres")
    )
    return totals.join(genres, "listener_key")


def _listener_days(gold: Gold) -> DataFrame:
    """First, last and number of active days per listener, from the daily aggregate."""
    active = gold.agg_daily_listener_streams.join(_days(gold, "full_date"), "date_key")
    return active.groupBy("listener_key").agg(
        F.min("full_date").alias("first_day"),
        F.max("full_date").alias("last_day"),
        F.count("*").alias("days"),
    )


def _completion() -> Column:
    return numbers.mean_completion(F.col("points"), F.col("streams"))


def _rate(measure: str) -> Column:
    return numbers.percent(F.col(measure), F.col("streams"))


def _total(column: str, *group: str) -> Column:
    """Sum over a group of already aggregated rows."""
    return F.sum(column).over(Window.partitionBy(*group))


# --- semantic views --------------------------------------------------------------------------------

def stream_details(gold: Gold) -> DataFrame:
    """One row per stream with all its context.

    Days and devices are looked up last, so that their text is in no shuffle.
    """
    listeners = _listener_names(
        gold, F.col("email").alias("listener_email"), "age_group", F.col("country").alias("listener_country"),
        "subscription_type", "tenure_months",
    )
    artists = gold.dim_artist.select(
        "artist_key", "artist_id", F.col("name").alias("artist_name"), F.col("genre").alias("artist_genre"),
        "popularity_tier", F.col("years_active").alias("artist_years_active"),
    )
    tracks = gold.dim_track.select(
        "track_key", "track_id", F.col("title").alias("track_title"), "artist_key", "album", "duration_ms",
        "duration_bucket", "genre", "release_year", "explicit",
    ).join(artists, "artist_key").drop("artist_key")
    days = _days(
        gold, F.col("full_date").alias("stream_date"), "year", "quarter", "month", "month_name", "week_of_year",
        "day_of_week", "day_name", "is_weekend", "is_holiday",
    )
    played = F.col("duration_played_ms")
    return (
        gold.described(listeners, tracks).join(days, "date_key")
        .join(F.broadcast(gold.dim_device), "device_key")
        .select(
            "stream_id", "streamed_at",
            "listener_id", "listener_name", "listener_email", "age_group", "listener_country", "subscription_type",
            "tenure_months",
            "track_id", "track_title", "album", F.col("duration_ms").alias("track_duration_ms"),
            numbers.in_seconds(F.col("duration_ms")).alias("track_duration_sec"), "duration_bucket", "genre",
            "release_year", "explicit",
            "artist_id", "artist_name", "artist_genre", "popularity_tier", "artist_years_active",
            "device_type", "device_category",
            "stream_date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_week", "day_name",
            "is_weekend", "is_holiday",
            "duration_played_ms",
            numbers.in_seconds(played).alias("duration_played_sec"),
            numbers.in_minutes(played, 2).alias("duration_played_min"),
            F.round("duration_played_pct", 1).alias("completion_pct"),
            "is_full_play", "shuffle_mode", "offline_mode",
        )
    )


def listener_summary(gold: Gold) -> DataFrame:
    """Activity, diversity and behaviour per listener."""
    listeners = gold.dim_listener.select(
        "listener_key", "listener_id", "full_name", "email", "age_group", "country", "subscription_type",
        "tenure_months",
    )
    ms, streams = F.col("played_ms"), F.col("streams")
    return (
        _listener_totals(gold).join(_listener_days(gold), "listener_key").join(listeners, "listener_key")
        .select(
            "listener_id", "full_name", "email", "age_group", "country", "subscription_type", "tenure_months",
            streams.alias("total_streams"),
            "full_plays",
            F.col("shuffled").alias("shuffle_streams"),
            F.col("offline").alias("offline_streams"),
            "unique_tracks", "unique_artists", "unique_genres",
            ms.alias("total_ms"),
            numbers.in_minutes(ms).alias("total_minutes"),
            numbers.in_hours(ms).alias("total_hours"),
            _completion().alias("avg_completion_pct"),
            F.round(ms / (streams * numbers.MS_PER_SECOND), 1).alias("avg_stream_duration_sec"),
            _rate("full_plays").alias("full_play_pct"),
            _rate("shuffled").alias("shuffle_pct"),
            _rate("offline").alias("offline_pct"),
            F.col("first_day").alias("first_stream_date"),
            F.col("last_day").alias("last_stream_date"),
            F.col("days").alias("active_days"),
        )
    )


def track_popularity(gold: Gold) -> DataFrame:
    """Plays, reach and ranks per track."""
    per_track = gold.listener_tracks.groupBy("track_key", "genre").agg(
        *summed(), F.count("*").alias("unique_listeners")
    )
    ranked = with_ranks(per_track, _track_plays(gold, "genre"), "streams", "overall_rank", "genre", "genre_rank")
    tracks = gold.dim_track.select(
        "track_key", "track_id", "title", "album", "release_year", "duration_bucket", "explicit", "artist_key"
    )
    artists = gold.dim_artist.select("artist_key", "artist_id", F.col("name").alias("artist_name"))
    return ranked.join(tracks, "track_key").join(artists, "artist_key").select(
        "track_id", "title", "album", "artist_name", "artist_id", "genre", "release_year", "duration_bucket", "explicit",
        F.col("streams").alias("stream_count"),
        "unique_listeners", "full_plays",
        numbers.in_minutes(F.col("played_ms")).alias("total_minutes_played"),
        _completion().alias("avg_completion_pct"),
        _rate("full_plays").alias("full_play_rate"),
        "overall_rank", "genre_rank",
    )


def artist_popularity(gold: Gold) -> DataFrame:
    """Plays, catalogue, reach and ranks per artist."""
    reach = (
        gold.listener_tracks.groupBy("artist_key", "listener_key").agg(*summed())
        .groupBy("artist_key").agg(*summed(), F.count("*").alias("unique_listeners"))
    )
    played = _track_plays(gold, "artist_key", "album")
    catalogue = played.groupBy("artist_key").agg(
        F.count("*").alias("tracks_in_catalog"), F.countDistinct("album").alias("albums")
    )
    genres = gold.dim_artist.select("artist_key", "genre")
    population = played.groupBy("artist_key").agg(F.sum("streams").alias("streams")).join(genres, "artist_key")
    ranked = with_ranks(
        reach.join(genres, "artist_key"), population, "streams", "overall_rank", "genre", "genre_rank"
    )
    artists = gold.dim_artist.select(
        "artist_key", "artist_id", F.col("name").alias("artist_name"), "country", "popularity_tier", "years_active",
        "monthly_listeners",
    )
    return ranked.join(catalogue, "artist_key").join(artists, "artist_key").select(
        "artist_id", "artist_name", "genre", "country", "popularity_tier", "years_active",
        "monthly_listeners", "tracks_in_catalog", "albums",
        F.col("streams").alias("total_streams"),
        "unique_listeners", "full_plays",
        numbers.in_minutes(F.col("played_ms")).alias("total_minutes_played"),
        numbers.in_hours(F.col("played_ms")).alias("total_hours_played"),
        _completion().alias("avg_completion_pct"),
        "overall_rank", "genre_rank",
    )


def genre_trends(gold: Gold) -> DataFrame:
    """Volume and share of each genre per month. Counts come from the monthly aggregate."""
    per_track = (
        gold.fact_streams.join(_days(gold, "year", "month", "month_name"), "date_key")
        .groupBy("year", "month", "month_name", "track_key")
        .agg(F.sum(numbers.completion_points(F.col("duration_played_pct"))).alias("points"))
    )
    completion = (
        per_track.join(gold.dim_track.select("track_key", "artist_key", "genre"), "track_key")
        .groupBy("year", "month", "month_name", "genre")
        .agg(F.sum("points").alias("points"), F.countDistinct("artist_key").alias("unique_artists"))
    )
    return gold.agg_monthly_genre_streams.join(completion, ["year", "month", "genre"]).select(
        "year", "month", "month_name", "genre", "stream_count", "unique_listeners", "unique_tracks", "unique_artists",
        numbers.in_hours(F.col("total_duration_ms")).alias("total_hours"),
        numbers.mean_completion(F.col("points"), F.col("stream_count")).alias("avg_completion_pct"),
        numbers.percent(F.col("stream_count"), _total("stream_count", "year", "month")).alias("month_share_pct"),
    )


def daily_platform_stats(gold: Gold) -> DataFrame:
    """Platform totals per day. All but the completion comes from the daily aggregates."""
    listeners = gold.agg_daily_listener_streams.groupBy("date_key").agg(
        F.sum("stream_count").alias("streams"),
        F.count("*").alias("active_listeners"),
        F.sum("total_duration_ms").alias("played_ms"),
        F.sum("full_plays").alias("full_plays"),
        F.sum("shuffle_streams").alias("shuffled"),
        F.sum("offline_streams").alias("offline"),
    )
    tracks = (
        gold.agg_daily_track_streams.join(gold.dim_track.select("track_key", "artist_key"), "track_key")
        .groupBy("date_key")
        .agg(F.count("*").alias("unique_tracks_played"), F.countDistinct("artist_key").alias("unique_artists_played"))
    )
    completion = gold.fact_streams.groupBy("date_key").agg(
        F.sum(numbers.completion_points(F.col("duration_played_pct"))).alias("points")
    )
    days = _days(gold, "full_date", "year", "month", "month_name", "day_name", "is_weekend", "is_holiday")
    return (
        listeners.join(tracks, "date_key").join(completion, "date_key").join(days, "date_key")
        .select(
            "full_date", "year", "month", "month_name", "day_name", "is_weekend", "is_holiday",
            F.col("streams").alias("total_streams"),
            "active_listeners", "unique_tracks_played", "unique_artists_played",
            numbers.in_hours(F.col("played_ms")).alias("total_hours_streamed"),
            _completion().alias("avg_completion_pct"),
            _rate("full_plays").alias("full_play_rate"),
            _rate("shuffled").alias("shuffle_pct"),
            _rate("offline").alias("offline_pct"),
        )
    )


# --- year in review --------------------------------------------------------------------------------

def top_artists_by_listener(gold: Gold, limit: int = TOP_ROWS) -> DataFrame:
    """Artists by time played. Ties go to the smaller artist id."""
    per_artist = gold.listener_tracks.groupBy("listener_key", "artist_key").agg(*summed())
    ranked = top_per_group(
        per_artist.join(gold.dim_artist.select("artist_key", "artist_id"), "artist_key"),
        ["listener_key"], [F.desc("played_ms"), F.asc("artist_id")], limit, "artist_rank",
    )
    artists = gold.dim_artist.select(
        "artist_key", F.col("name").alias("artist_name"), F.col("genre").alias("artist_genre"), "popularity_tier"
    )
    return ranked.join(artists, "artist_key").join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name", "artist_id", "artist_name", "artist_genre", "popularity_tier",
        F.col("streams").alias("stream_count"),
        "full_plays",
        numbers.in_minutes(F.col("played_ms")).alias("minutes_listened"),
        "artist_rank",
    )


def top_tracks_by_listener(gold: Gold, limit: int = TOP_ROWS) -> DataFrame:
    """Tracks by number of plays. Ties go to the smaller track id."""
    pairs = gold.listener_tracks.drop("artist_key", "genre")
    ranked = top_per_group(
        pairs.join(gold.dim_track.select("track_key", "track_id"), "track_key"),
        ["listener_key"], [F.desc("streams"), F.asc("track_id")], limit, "track_rank",
    )
    tracks = gold.dim_track.select("track_key", F.col("title").alias("track_title"), "album", "genre", "artist_key")
    artists = gold.dim_artist.select("artist_key", F.col("name").alias("artist_name"))
    return (
        ranked.join(tracks, "track_key").join(artists, "artist_key").join(_listener_names(gold), "listener_key")
        .select(
            "listener_id", "listener_name", "track_id", "track_title", "album", "artist_name", "genre",
            F.col("streams").alias("play_count"),
            "full_plays",
            numbers.in_minutes(F.col("played_ms")).alias("minutes_listened"),
            _completion().alias("avg_completion_pct"),
            "track_rank",
        )
    )


def top_genre_by_listener(gold: Gold) -> DataFrame:
    """The genre played longest; ties go to the first by name.

    ``genre_share_pct`` is the share among the rows that are left, so always 100 (null for a genre
    that rounds to no minutes); ``genre_share_of_total_pct`` is the share of all the listener's time.
    """
    per_genre = gold.listener_tracks.groupBy("listener_key", "genre").agg(
        *summed(),
        F.count("*").alias("unique_tracks"),
        F.countDistinct("artist_key").alias("unique_artists"),
    )
    # The total is taken before the cut; both windows use the one shuffle by listener.
    per_genre = per_genre.withColumn("total_ms", _total("played_ms", "listener_key"))
    top = top_per_group(per_genre, ["listener_key"], [F.desc("played_ms"), F.asc("genre")], 1, "genre_rank")
    minutes = numbers.in_minutes(F.col("played_ms"))
    return top.join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name",
        F.col("genre").alias("top_genre"),
        F.col("streams").alias("stream_count"),
        "unique_tracks", "unique_artists",
        minutes.alias("minutes_listened"),
        F.when(minutes != 0, F.round(minutes * 100.0 / minutes, 1)).alias("genre_share_pct"),
        F.when(F.col("total_ms") != 0, numbers.percent(F.col("played_ms"), F.col("total_ms"))).alias(
            "genre_share_of_total_pct"
        ),
    )


def listening_personality(
    gold: Gold, rules: classify.PersonalityRules = classify.PersonalityRules(),
) -> DataFrame:
    """A label per listener, and the figures it rests on."""
    label = classify.personality(
        F.col("streams"), F.col("unique_artists"), F.col("unique_genres"), F.col("shuffled"), F.col("full_plays"),
        F.col("offline"), rules,
    )
    return _listener_totals(gold).join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name",
        label.alias("listening_personality"),
        F.col("streams").alias("total_streams"),
        "unique_artists", "unique_tracks", "unique_genres",
        _rate("shuffled").alias("shuffle_pct"),
        _rate("full_plays").alias("full_play_pct"),
        _rate("offline").alias("offline_pct"),
    )


def monthly_trends_by_listener(gold: Gold) -> DataFrame:
    """Per listener and month of the year; equal months of different years are one row.

    Tracks and artists are counted as rows of earlier groupings, as in the daily aggregate.
    """
    month = ["listener_key", "month"]
    any_day = F.min("date_key").alias("date_key")  # whose name is looked up in the end
    # What a listener plays in a month lies together from here on, so that none of the groupings is a shuffle of its own.
    plays = gold.plays.join(_days(gold, "month"), "date_key").repartition(*month)
    per_track = roll_up(plays, *month, "artist_key", "track_key", extra=(any_day,))
    per_artist = per_track.groupBy(*month, "artist_key").agg(*summed(), F.count("*").alias("unique_tracks"), any_day)
    # An artist that is not known counts as none.
    monthly = per_artist.groupBy(*month).agg(
        *summed(), F.sum("unique_tracks").alias("unique_tracks"), F.count("artist_key").alias("unique_artists"), any_day
    ).join(_days(gold, "month_name"), "date_key")
    return monthly.join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name", "month", "month_name", "streams", "unique_tracks", "unique_artists",
        numbers.in_minutes(F.col("played_ms")).alias("minutes_listened"),
        numbers.in_hours(F.col("played_ms")).alias("hours_listened"),
    )


def peak_listening_times(gold: Gold, limit: int = TOP_TIMES) -> DataFrame:
    """The busiest times of day per listener, with their share of all plays; ties by name."""
    bands = gold.fact_streams.groupBy("listener_key", classify.time_of_day(F.col("streamed_at")).alias("time_of_day"))
    counted = bands.agg(F.count("*").alias("stream_count"))
    counted = counted.withColumn("total", _total("stream_count", "listener_key"))
    top = top_per_group(counted, ["listener_key"], [F.desc("stream_count"), F.asc("time_of_day")], limit, "time_rank")
    return top.join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name", "time_of_day", "stream_count", "time_rank",
        numbers.percent(F.col("stream_count"), F.col("total")).alias("pct_of_listening"),
    )


def weekday_vs_weekend(gold: Gold) -> DataFrame:
    """Weekday and weekend listening side by side, from the daily aggregate."""
    weekend = F.col("is_weekend") == 1

    def part(column: str, condition):
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    split = (
        gold.agg_daily_listener_streams.join(_days(gold, "is_weekend"), "date_key")
        .groupBy("listener_key")
        .agg(
            part("stream_count", ~weekend).alias("weekday_streams"),
            part("stream_count", weekend).alias("weekend_streams"),
            part("total_duration_ms", ~weekend).alias("weekday_ms"),
            part("total_duration_ms", weekend).alias("weekend_ms"),
        )
    )
    weekdays, weekends = F.col("weekday_streams"), F.col("weekend_streams")
    return split.join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name", weekdays, weekends,
        numbers.in_minutes(F.col("weekday_ms")).alias("weekday_minutes"),
        numbers.in_minutes(F.col("weekend_ms")).alias("weekend_minutes"),
        F.round(weekdays / float(classify.WEEKDAYS_PER_YEAR), 1).alias("avg_weekday_streams"),
        F.round(weekends / float(classify.WEEKEND_DAYS_PER_YEAR), 1).alias("avg_weekend_streams"),
        classify.week_habit(weekdays, weekends).alias("listener_type"),
    )


def discovery_stats(gold: Gold) -> DataFrame:
    """Artists met per quarter. A quarter counts the artists of whom some track was first heard in it,
    so an artist may count in several; the ``first_…`` columns count each artist once, at first hearing."""
    quarters = range(1, 5)
    per_artist = gold.listener_tracks.groupBy("listener_key", "artist_key").agg(
        F.count("*").alias("tracks"),
        *(F.max(F.when(F.quarter("first_heard") == q, 1).otherwise(0)).alias(f"_q{q}") for q in quarters),
        F.quarter(F.min("first_heard")).alias("_first_quarter"),
    )
    per_listener = per_artist.groupBy("listener_key").agg(
        F.count("*").alias("total_artists_played"),
        F.sum("tracks").alias("total_tracks_played"),
        *(F.sum(f"_q{q}").alias(f"q{q}_new_artists") for q in quarters),
        *(F.sum(F.when(F.col("_first_quarter") == q, 1).otherwise(0)).alias(f"first_q{q}_artists") for q in quarters),
    )
    return per_listener.join(_listener_names(gold), "listener_key").select(
        "listener_id", "listener_name", "total_artists_played", "total_tracks_played",
        *(f"q{q}_new_artists" for q in quarters),
        *(f"first_q{q}_artists" for q in quarters),
    )


def year_in_review_summary(gold: Gold) -> DataFrame:
    """Everything about a listener's year in one row, and how they compare with all others."""
    listeners = _listener_names(gold, "subscription_type", "country")
    days = _listener_days(gold).select("listener_key", "days")
    population = gold.agg_daily_listener_streams.groupBy("listener_key").agg(
        F.sum("total_duration_ms").alias("played_ms")
    )
    compared = with_percent_rank(_listener_totals(gold), population, "played_ms", "_percent_rank")
    ms = F.col("played_ms")
    return compared.join(days, "listener_key").join(listeners, "listener_key").select(
        "listener_id", "listener_name", "subscription_type", "country",
        F.col("streams").alias("total_streams"),
        numbers.in_minutes(ms, 0).alias("total_minutes"),
        numbers.in_hours(ms).alias("total_hours"),
        F.col("days").alias("days_active"),
        "unique_tracks", "unique_artists", "unique_genres",
        _completion().alias("avg_completion_pct"),
        "full_plays",
        _rate("full_plays").alias("full_play_rate"),
        _rate("shuffled").alias("shuffle_pct"),
        _rate("offline").alias("offline_pct"),
        F.round(F.col("_percent_rank") * 100, 0).alias("listening_percentile"),
    )


# --- catalogue -------------------------------------------------------------------------------------

VIEWS: dict[str, Callable[[Gold], DataFrame]] = {
    "v_stream_details": stream_details,
    "v_listener_summary": listener_summary,
    "v_track_popularity": track_popularity,
    "v_artist_popularity": artist_popularity,
    "v_genre_trends": genre_trends,
    "v_daily_platform_stats": daily_platform_stats,
    "v_top_artists_by_listener": top_artists_by_listener,
    "v_top_tracks_by_listener": top_tracks_by_listener,
    "v_top_genre_by_listener": top_genre_by_listener,
    "v_listening_personality": listening_personality,
    "v_monthly_trends_by_listener": monthly_trends_by_listener,
    "v_peak_listening_times": peak_listening_times,
    "v_weekday_vs_weekend": weekday_vs_weekend,
    "v_discovery_stats": discovery_stats,
    "v_year_in_review_summary": year_in_review_summary,
}

# Order in which a view is presented, "-" for descending; the views themselves stay unsorted.
SORT_ORDER = {
    "v_genre_trends": ["year", "month", "-stream_count", "genre"],
    "v_daily_platform_stats": ["full_date"],
    "v_monthly_trends_by_listener": ["listener_id", "month"],
    "v_peak_listening_times": ["listener_id", "time_rank"],
}


def presented(view: str, df: DataFrame) -> DataFrame:
    """Sort a view for its reader."""
    order = [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in SORT_ORDER.get(view, [])]
    return df.orderBy(*order) if order else df


def register_views(spark: SparkSession, gold: Gold) -> list[str]:
    """Make every view and gold table available to ``spark.sql``; nothing is computed yet."""
    for name, table in gold.tables().items():
        table.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(gold).createOrReplaceTempView(name)
    return list(VIEWS)
