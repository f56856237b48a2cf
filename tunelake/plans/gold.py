"""Gold layer: a star schema of listening events and its daily and monthly aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake import schemas
from tunelake.functions import classify, dates, numbers
from tunelake.operators.lookups import by_shuffle, having_key
from tunelake.operators.rollups import roll_up
from tunelake.operators.surrogate import with_dense_key
from tunelake.plans.silver import Silver, Stage, unstaged
from tunelake.sources.layers import LayerStore, gathered

LAYER = "gold"
WORK_LAYER = "gold_work"


@dataclass(frozen=True)
class Calendar:
    """Days covered by the date dimension, and the days that ages and tenures are measured to."""

    first_day: str = "2025-01-01"
    last_day: str = "2025-12-31"
    ages_as_of: str = "2025-01-01"
    tenure_as_of: str = "2025-12-31"
    current_year: int = 2025


# --- dimensions -------------------------------------------------------------------------------------

def dim_date(spark: SparkSession, calendar: Calendar) -> DataFrame:
    """One row per day of the calendar."""
    first, last = (F.lit(day).cast("date") for day in (calendar.first_day, calendar.last_day))
    day = F.col("full_date")
    return (
        spark.range(0, 1, 1, 1)
        .select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))
        .select(
            dates.date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            dates.monday_week_number(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            dates.sunday_based_weekday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            dates.is_weekend(day).alias("is_weekend"),
            dates.is_fixed_holiday(day).alias("is_holiday"),
        )
    )


def dim_device(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"struct({key} AS device_key, '{kind}' AS device_type, '{category}' AS device_category)"
        for key, (kind, category) in enumerate(classify.DEVICE_CATEGORIES, start=1)
    )
    devices = spark.range(0, 1, 1, 1).selectExpr(f"inline(array({rows}))")
    return schemas.conform(devices, schemas.GOLD["dim_device"])


def dim_artist(artists: DataFrame, calendar: Calendar) -> DataFrame:
    described = artists.select(
        "*",
        (F.lit(calendar.current_year) - F.col("formed_year")).alias("years_active"),
        classify.popularity_tier(F.col("monthly_listeners")).alias("popularity_tier"),
    )
    return schemas.conform(with_dense_key(described, "artist_id", "artist_key"), schemas.GOLD["dim_artist"])


def dim_listener(listeners: DataFrame, calendar: Calendar) -> DataFrame:
    described = listeners.select(
        "*",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        classify.age_group(dates.age_in_years(F.col("birth_date"), calendar.ages_as_of)).alias("age_group"),
        dates.months_until(F.col("created_at"), calendar.tenure_as_of).alias("tenure_months"),
    )
    return schemas.conform(with_dense_key(described, "listener_id", "listener_key"), schemas.GOLD["dim_listener"])


def dim_track(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """``artists`` is the artist dimension; its key replaces the artist's natural id."""
    described = tracks.join(artists.select("artist_id", "artist_key"), "artist_id").select(
        "*",
        classify.duration_bucket(F.col("duration_ms")).alias("duration_bucket"),
        F.year("release_date").alias("release_year"),
    )
    return schemas.conform(with_dense_key(described, "track_id", "track_key"), schemas.GOLD["dim_track"])


# --- fact -------------------------------------------------------------------------------------------

def fact_streams(
    streams: DataFrame, listeners: DataFrame, tracks: DataFrame, devices: DataFrame, days: DataFrame, *described: str,
    of_listeners: Sequence[str] = (),
) -> DataFrame:
    """Streams with the keys of all dimensions, without ``stream_key``; ``described`` columns of the tracks stay, and
    ``of_listeners`` those of the listeners.

    A stream of an unknown device or of a day outside the calendar is left out. Devices and days are
    broadcast: the one is a fixed list, the other a line per calendar day. Listeners and tracks can
    be of any size, so they are joined by a shuffle.
    """
    played = numbers.played_percent(F.col("duration_played_ms"), F.col("duration_ms"))
    return (
        streams.withColumn("date_key", dates.date_key(F.col("streamed_at")))
        .join(F.broadcast(days.select("date_key")), "date_key", "left_semi")
        .join(F.broadcast(devices.select("device_type", "device_key")), "device_type")
        .join(by_shuffle(_once(listeners, "listener_id", "listener_key", *of_listeners)), "listener_id")
        .join(by_shuffle(_once(tracks, "track_id", "track_key", "duration_ms", *described)), "track_id")
        .select(
            "date_key", "listener_key", "track_key", "device_key", "stream_id", "streamed_at", "duration_played_ms",
            F.coalesce(F.round(played, 2), F.lit(0.0)).alias("duration_played_pct"),
            "shuffle_mode", "offline_mode",
            F.when(played >= classify.FULL_PLAY_PERCENT, 1).otherwise(0).alias("is_full_play"),
            *of_listeners, *described,
        )
    )


def _once(df: DataFrame, *columns: str) -> DataFrame:
    """Some columns, also those named twice."""
    return df.select(*dict.fromkeys(columns))


def with_stream_key(fact: DataFrame) -> DataFrame:
    """Number the fact rows; unique within one write and needs no shuffle."""
    return fact.withColumn("stream_key", F.monotonically_increasing_id() + 1)


def unplaced_streams(streams: DataFrame, devices: DataFrame, days: DataFrame) -> DataFrame:
    """Streams that the fact leaves out, with the reason."""
    keyed = streams.withColumn("date_key", dates.date_key(F.col("streamed_at")))
    known_day = days.select("date_key", F.lit(True).alias("_day"))
    known_device = devices.select("device_type", F.lit(True).alias("_device"))
    reason = F.coalesce(
        F.when(F.col("_device").isNull(), F.concat(F.lit("Unknown device_type: "), "device_type")),
        F.when(F.col("_day").isNull(), F.concat(F.lit("Outside calendar: "), F.col("date_key").cast("string"))),
    )
    return (
        keyed.join(F.broadcast(known_day), "date_key", "left")
        .join(F.broadcast(known_device), "device_type", "left")
        .select("stream_id", reason.alias("reason"))
        .where("reason is not null")
    )


# --- aggregates -------------------------------------------------------------------------------------

def agg_daily_listener_streams(fact: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per day and listener. Plays of a track are merged first, so distinct tracks are a row count.

    Both are merged by artist then, so that distinct artists are one as well; a distinct count beside sums would
    shuffle all sums once more.
    """
    sums = ["stream_count", "total_duration_ms", "shuffle_streams", "offline_streams", "full_plays"]
    day = ["date_key", "listener_key"]
    # What a listener plays on a day lies together from here on, so that none of the groupings is a shuffle of its own.
    plays = fact.join(tracks.select("track_key", "artist_key"), "track_key").repartition(*day)
    per_track = plays.groupBy(*day, "artist_key", "track_key").agg(
        F.count("*").alias("stream_count"),
        F.sum("duration_played_ms").alias("total_duration_ms"),
        F.sum("shuffle_mode").alias("shuffle_streams"),
        F.sum("offline_mode").alias("offline_streams"),
        F.sum("is_full_play").alias("full_plays"),
    )
    per_artist = per_track.groupBy(*day, "artist_key").agg(
        *(F.sum(column).alias(column) for column in sums), F.count("*").alias("unique_tracks")
    )
    # An artist that is not known counts as none.
    counted = per_artist.groupBy(*day).agg(
        *(F.sum(column).alias(column) for column in [*sums, "unique_tracks"]),
        F.count("artist_key").alias("unique_artists"),
    )
    return schemas.conform(counted, schemas.GOLD["agg_daily_listener_streams"])


def agg_daily_track_streams(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("date_key", "track_key").agg(
        F.count("*").alias("stream_count"),
        F.countDistinct("listener_key").alias("unique_listeners"),
        F.sum("duration_played_ms").alias("total_duration_ms"),
        F.sum("is_full_play").alias("full_plays"),
    )
    return schemas.conform(counted, schemas.GOLD["agg_daily_track_streams"])


def agg_monthly_genre_streams(fact: DataFrame, tracks: DataFrame, days: DataFrame) -> DataFrame:
    """Per month and genre. Distinct listeners and tracks cannot be added up from the daily tables.

    The genre is looked up first, so that the rows are shuffled by listener once; the tracks of a month are few beside
    its plays. Rows are counted after a grouping by each key; two distinct counts at once would double the rows first.
    """
    dated = fact.join(F.broadcast(days.select("date_key", "year", "month")), "date_key")
    genres = tracks.select("track_key", "genre")
    month = ["year", "month", "genre"]
    by_listener = dated.join(genres, "track_key").groupBy(*month, "listener_key").agg(
        F.count("*").alias("stream_count"), F.sum("duration_played_ms").alias("total_duration_ms")
    )
    counted = by_listener.groupBy(*month).agg(
        F.sum("stream_count").alias("stream_count"), F.count("*").alias("unique_listeners"),
        F.sum("total_duration_ms").alias("total_duration_ms"),
    )
    heard = dated.select("year", "month", "track_key").distinct().join(genres, "track_key").groupBy(*month).agg(
        F.count("*").alias("unique_tracks")
    )
    return schemas.conform(counted.join(heard, month), schemas.GOLD["agg_monthly_genre_streams"])


def listener_tracks(fact: DataFrame, tracks: DataFrame) -> DataFrame:
    """Plays per (listener, track), with the track's artist and genre and the first hearing.

    Repeated plays are merged before the first shuffle, and the tracks are looked up for the merged
    rows only. Everything in it can be added up further, and a distinct count of tracks per listener,
    or of listeners per track, is a row count.
    """
    pairs = roll_up(fact, "listener_key", "track_key", extra=(F.min("streamed_at").alias("first_heard"),))
    return pairs.join(tracks.select("track_key", "artist_key", "genre"), "track_key")


# --- the layer --------------------------------------------------------------------------------------

class Gold:
    """The star and its aggregates, each table derived on first use; ``stage`` is as in the silver layer."""

    def __init__(self, spark: SparkSession, silver: Silver, calendar: Calendar, stage: Stage = unstaged):
        self._spark = spark
        self._silver = silver
        self._calendar = calendar
        self._stage = stage

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stage("dim_date", dim_date(self._spark, self._calendar))

    @cached_property
    def dim_device(self) -> DataFrame:
        return self._stage("dim_device", dim_device(self._spark))

    @cached_property
    def dim_artist(self) -> DataFrame:
        return self._stage("dim_artist", dim_artist(self._silver.artists, self._calendar))

    @cached_property
    def dim_listener(self) -> DataFrame:
        return self._stage("dim_listener", dim_listener(self._silver.listeners, self._calendar))

    @cached_property
    def dim_track(self) -> DataFrame:
        return self._stage("dim_track", dim_track(self._silver.tracks, self.dim_artist))

    @cached_property
    def fact_streams(self) -> DataFrame:
        fact = fact_streams(self._silver.streams, self.dim_listener, self.dim_track, self.dim_device, self.dim_date)
        return self._stage("fact_streams", fact)

    @cached_property
    def plays(self) -> DataFrame:
        """The fact with the artist of each track."""
        return self.fact_streams.join(self.dim_track.select("track_key", "artist_key"), "track_key")

    def described(self, listeners: DataFrame, tracks: DataFrame) -> DataFrame:
        """The fact with what is given of its listeners and tracks: columns of the dimensions, with their ids and keys, and
        with the ``duration_ms`` of the tracks."""
        return self.fact_streams.join(listeners, "listener_key").join(tracks, "track_key")

    @cached_property
    def agg_daily_listener_streams(self) -> DataFrame:
        counted = agg_daily_listener_streams(self.fact_streams, self.dim_track)
        return self._stage("agg_daily_listener_streams", counted)

    @cached_property
    def agg_daily_track_streams(self) -> DataFrame:
        return self._stage("agg_daily_track_streams", agg_daily_track_streams(self.fact_streams))

    @cached_property
    def agg_monthly_genre_streams(self) -> DataFrame:
        counted = agg_monthly_genre_streams(self.fact_streams, self.dim_track, self.dim_date)
        return self._stage("agg_monthly_genre_streams", counted)

    @cached_property
    def listener_tracks(self) -> DataFrame:
        """The roll-up that most views start from; not part of the layer itself."""
        return self._stage("listener_tracks", listener_tracks(self.fact_streams, self.dim_track))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schemas.GOLD}

    def starting_from(self, **tables: DataFrame) -> Gold:
        """Take tables that exist already instead of deriving them."""
        vars(self).update(tables)
        return self

    def for_listeners(self, listener_ids: DataFrame) -> Gold:
        """The same star with the plays of some listeners only, for per-listener lookups."""
        listeners = having_key(self.dim_listener, listener_ids, "listener_id")
        by_listener = ("fact_streams", "agg_daily_listener_streams", "listener_tracks")
        return self._changed(
            dim_listener=lambda star: listeners,
            **{name: lambda star, n=name: having_key(getattr(self, n), listeners, "listener_key") for name in by_listener},
        )

    def _changed(self, **changes: Callable[[Gold], DataFrame]) -> Gold:
        """The star with some tables made anew; each table, new or old, is only obtained on first use."""
        kept = {name: lambda star, n=name: getattr(self, n) for name in (*schemas.GOLD, "listener_tracks")}
        members = {name: cached_property(make) for name, make in (kept | changes).items()}
        return type("ChangedGold", (GivenGold,), members)()

    def between(self, first_day: str, last_day: str) -> Gold:
        """The star restricted to a span of days; of a written star only the months concerned are read."""
        first, last = (int(day.replace("-", "")) for day in (first_day, last_day))

        def restricted(df: DataFrame) -> DataFrame:
            kept = df.where(F.col("date_key").between(first, last))
            if MONTH_FOLDER in df.columns:
                kept = kept.where(F.col(MONTH_FOLDER).between(first // 100, last // 100))
            return kept

        if not (first_day.endswith("-01") and _is_month_end(last_day)):
            raise ValueError("a span must start and end with a month, as some aggregates are monthly")
        months = F.col("year") * 100 + F.col("month")
        return self._changed(
            agg_monthly_genre_streams=lambda star: self.agg_monthly_genre_streams.where(
                months.between(first // 100, last // 100)
            ),
            listener_tracks=lambda star: listener_tracks(star.fact_streams, star.dim_track),
            **{name: lambda star, n=name: restricted(getattr(self, n)) for name in BY_MONTH},
        )


class UnwrittenFact(Gold):
    """A star whose fact is not written: what reads it derives the columns that it uses, and no others."""

    @cached_property
    def plays(self) -> DataFrame:
        return fact_streams(
            self._silver.streams, self.dim_listener, self.dim_track, self.dim_device, self.dim_date, "artist_key"
        )

    @cached_property
    def fact_streams(self) -> DataFrame:
        return self.plays.drop("artist_key")

    def described(self, listeners: DataFrame, tracks: DataFrame) -> DataFrame:
        """What is given is taken along as the keys are looked up, so that the rows are shuffled by ids only, and once by each.

        The day is in the time, so it is not shuffled beside it.
        """
        fact = fact_streams(
            self._silver.streams, listeners, tracks, self.dim_device, self.dim_date,
            *(column for column in tracks.columns if column != "track_key"),
            of_listeners=[column for column in listeners.columns if column != "listener_key"],
        )
        return fact.withColumn("date_key", dates.date_key(F.col("streamed_at")))


class GivenGold(Gold):
    """Gold tables that exist already."""

    def __init__(self, **tables: DataFrame):
        vars(self).update(tables)


def _is_month_end(day: str) -> bool:
    return (date.fromisoformat(day) + timedelta(days=1)).day == 1


# Tables that grow with the events, written in one folder per month.
BY_MONTH = ["fact_streams", "agg_daily_listener_streams", "agg_daily_track_streams"]
MONTH_FOLDER = "date_month"


def writing(store: LayerStore, silver: Silver, calendar: Calendar, kind: type[Gold] = Gold) -> Gold:
    """The layer, each table written on first use, before the next ones read it."""

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name == "listener_tracks":
            pairs = schemas.conform(df, schemas.LISTENER_TRACKS)
            return store.replace(WORK_LAYER, name, pairs, schemas.LISTENER_TRACKS)
        ddl = schemas.GOLD[name]
        if name not in BY_MONTH:
            return store.replace(LAYER, name, schemas.conform(df, ddl), ddl)
        monthly = gathered(df.withColumn(MONTH_FOLDER, F.floor(F.col("date_key") / 100).cast("int")), MONTH_FOLDER)
        if name == "fact_streams":
            # After the last shuffle, so that a repeated task cannot hand out other keys.
            monthly = with_stream_key(monthly)
        ddl = f"{ddl}, {MONTH_FOLDER} int"
        return store.replace(LAYER, name, schemas.conform(monthly, ddl), ddl, MONTH_FOLDER)

    return kind(store.spark, silver, calendar, stage)


def read(store: LayerStore) -> Gold:
    months = {name: f", {MONTH_FOLDER} int" for name in BY_MONTH}
    tables = {name: store.read(LAYER, name, ddl + months.get(name, "")) for name, ddl in schemas.GOLD.items()}
    return GivenGold(**tables, listener_tracks=store.read(WORK_LAYER, "listener_tracks", schemas.LISTENER_TRACKS))
