"""Silver layer: typed, cleaned, deduplicated tables; everything refused is logged with a reason.

Rows that break a key or a domain rule go to the rejected records instead of stopping the load.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake import schemas
from tunelake.functions import dates, text
from tunelake.operators.dedup import drop_copies, repeated_keys, with_shared_keys
from tunelake.operators.lookups import by_shuffle, having_key, lacking_key
from tunelake.plans.bronze import Bronze
from tunelake.sources.layers import LayerStore

LAYER = "silver"
# With the work tables that are written on the way to the streams, outside the layer.
DDL = {
    **schemas.SILVER, "referenced_streams": f"{schemas.SILVER['streams']}, _stream_id string, _orphan string",
    "shared_stream_id": "stream_id string",
}
# Allowed subscription types (fixed values).
SUBSCRIPTIONS = ["free", "premium"]


# --- cleaning: one projection per table -------------------------------------------------------

def clean_listeners(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("listener_id").alias("listener_id"),
        F.lower(F.trim("email")).alias("email"),
        F.trim("username").alias("username"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.when(text.present(F.col("birth_date")), dates.iso_date(F.col("birth_date"))).alias("birth_date"),
        text.known_text(F.col("city")).alias("city"),
        F.trim("country").alias("country"),
        F.lower(F.trim("subscription_type")).alias("subscription_type"),
        dates.event_time(F.col("created_at")).alias("created_at"),
    )


def clean_artists(raw: DataFrame) -> DataFrame:
    year = F.when(text.present(F.col("formed_year")), text.whole_number(F.col("formed_year")))
    return raw.select(
        F.trim("artist_id").alias("artist_id"),
        F.trim("name").alias("name"),
        text.capitalised(F.col("genre")).alias("genre"),
        F.trim("country").alias("country"),
        year.try_cast("int").alias("formed_year"),
        text.whole_number(F.col("monthly_listeners")).alias("monthly_listeners"),
    )


def clean_tracks(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("track_id").alias("track_id"),
        F.trim("title").alias("title"),
        F.trim("artist_id").alias("artist_id"),
        text.known_text(F.col("album")).alias("album"),
        text.whole_number(F.col("duration_ms")).alias("duration_ms"),
        text.capitalised(F.col("genre")).alias("genre"),
        dates.mixed_date(F.col("release_date")).alias("release_date"),
        text.flag(F.col("explicit")).alias("explicit"),
    )


def clean_streams(raw: DataFrame, *kept: str) -> DataFrame:
    return raw.select(
        *kept,
        F.trim("stream_id").alias("stream_id"),
        F.trim("listener_id").alias("listener_id"),
        F.trim("track_id").alias("track_id"),
        dates.event_time(F.col("streamed_at")).alias("streamed_at"),
        text.whole_number(F.col("duration_played_ms")).alias("duration_played_ms"),
        F.trim("device_type").alias("device_type"),
        text.flag(F.col("shuffle_mode")).alias("shuffle_mode"),
        text.flag(F.col("offline_mode")).alias("offline_mode"),
    )


# --- rules --------------------------------------------------------------------------------------

def _required(*columns: str) -> list[tuple[Column, str]]:
    return [(F.col(column).isNull(), f"Missing or unreadable {column}") for column in columns]


def domain_rules(table: str) -> list[tuple[Column, str]]:
    """(condition of a broken rule, reason). The first broken rule names the reason."""
    if table == "listeners":
        unknown_subscription = ~F.col("subscription_type").isin(SUBSCRIPTIONS)
        return _required(
            "listener_id", "email", "username", "first_name", "last_name", "country", "subscription_type",
            "created_at",
        ) + [(unknown_subscription, "Unknown subscription_type")]
    return {
        "artists": _required("artist_id", "name", "genre", "country", "monthly_listeners"),
        "tracks": _required("track_id", "title", "artist_id", "duration_ms", "genre", "release_date"),
        "streams": _required(
            "stream_id", "listener_id", "track_id", "streamed_at", "duration_played_ms", "device_type"
        ),
    }[table]


def broken_rule(table: str) -> Column:
    """Reason of the first broken domain rule, or null for a sound row."""
    return F.coalesce(*(F.when(broken, F.lit(reason)) for broken, reason in domain_rules(table)))


def rejections(df: DataFrame, table: str, id_column: str, reason: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("source_table"),
        F.col(id_column).alias("source_id"),
        reason.alias("rejection_reason"),
    )


Stage = Callable[[str, DataFrame], DataFrame]


def unstaged(name: str, df: DataFrame) -> DataFrame:
    """Leave a table lazy."""
    return df


def judged(candidates: DataFrame, table: str, keys: Sequence[str], stage: Stage = unstaged) -> DataFrame:
    """Add ``_reason``: why a row is refused, or null for a sound one.

    The domain rules come first; rows that pass them must not share a key with one another. ``stage``
    may write the repeated keys, so that Spark knows their size when it plans the join.
    """
    ruled = candidates.withColumn("_broken", broken_rule(table))
    passed = ruled.where("_broken is null")
    flagged = with_shared_keys(ruled, {key: stage(f"shared_{key}", repeated_keys(passed, key)) for key in keys})
    shared = (F.when(F.col(f"_shared_{key}"), text.labelled(f"Duplicate {key}: ", F.col(key))) for key in keys)
    return flagged.select(*candidates.columns, F.coalesce("_broken", *shared).alias("_reason"))


def sound(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where("_reason is null").drop("_reason")


def refused(judged_rows: DataFrame, table: str, id_column: str) -> DataFrame:
    return rejections(judged_rows.where("_reason is not null"), table, id_column, F.col("_reason"))


# --- references ---------------------------------------------------------------------------------

def _with_trimmed(raw: DataFrame, *columns: str) -> DataFrame:
    """Add the trimmed form of key columns under a leading underscore; the raw text is kept for the log."""
    return raw.withColumns({f"_{column}": F.trim(column) for column in columns})


def _ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias(f"_{column}"))


def tracks_without_artist(raw_tracks: DataFrame, artists: DataFrame) -> DataFrame:
    orphans = lacking_key(_with_trimmed(raw_tracks, "artist_id"), _ids(artists, "artist_id"), "_artist_id")
    return rejections(orphans, "tracks", "track_id", text.labelled("Invalid artist_id: ", F.col("artist_id")))


def referenced_streams(raw_streams: DataFrame, listeners: DataFrame, tracks: DataFrame) -> DataFrame:
    """Clean streams without copies, with the id as given and what is wrong with their references, if anything.

    One look at the streams and one at each reference; a stream whose track is unknown gets that reason only.
    """
    return with_references(_without_copies(raw_streams, "streams"), listeners, tracks)


def with_references(given: DataFrame, listeners: DataFrame, tracks: DataFrame, *kept: str) -> DataFrame:
    """The same for raw streams that are no copies of one another; ``kept`` columns stay."""
    raw_ids = {f"_{column}": F.col(column) for column in ("stream_id", "track_id", "listener_id")}
    clean = clean_streams(given.withColumns(raw_ids), *raw_ids, *kept)
    known_tracks = by_shuffle(tracks.select("track_id", F.lit(True).alias("_track")))
    known_listeners = by_shuffle(listeners.select("listener_id", F.lit(True).alias("_listener")))
    known = clean.join(known_tracks, "track_id", "left").join(known_listeners, "listener_id", "left")
    orphan = F.coalesce(
        F.when(F.col("_track").isNull(), text.labelled("Invalid track_id: ", F.col("_track_id"))),
        F.when(F.col("_listener").isNull(), text.labelled("Invalid listener_id: ", F.col("_listener_id"))),
    )
    return known.withColumn("_orphan", orphan).drop("_track", "_listener", "_track_id", "_listener_id")


def streams_without_reference(referenced: DataFrame) -> DataFrame:
    """Each refused stream once, however many records it has."""
    orphans = referenced.where("_orphan is not null")
    return rejections(orphans, "streams", "_stream_id", F.col("_orphan")).distinct()


# --- the layer ------------------------------------------------------------------------------------

def _without_copies(raw: DataFrame, table: str) -> DataFrame:
    return drop_copies(raw, schemas.RAW_FIELDS[table])


class Silver:
    """The silver tables, each derived on first use.

    ``stage(name, df)`` may write a table that others start from and return it as read back.
    """

    def __init__(self, bronze: Bronze, rejected_at: str, stage: Stage = unstaged):
        self._bronze = bronze
        self._rejected_at = rejected_at
        self._stage = stage

    def _staged(self, name: str, df: DataFrame) -> DataFrame:
        return self._stage(name, schemas.conform(df, DDL[name]))

    @cached_property
    def _judged_listeners(self) -> DataFrame:
        candidates = clean_listeners(_without_copies(self._bronze.listeners, "listeners"))
        return judged(candidates, "listeners", ["listener_id", "email"])

    @cached_property
    def listeners(self) -> DataFrame:
        return self._staged("listeners", sound(self._judged_listeners))

    @cached_property
    def _judged_artists(self) -> DataFrame:
        return judged(clean_artists(_without_copies(self._bronze.artists, "artists")), "artists", ["artist_id"])

    @cached_property
    def artists(self) -> DataFrame:
        return self._staged("artists", sound(self._judged_artists))

    @cached_property
    def _judged_tracks(self) -> DataFrame:
        candidates = clean_tracks(_without_copies(self._bronze.tracks, "tracks"))
        return judged(having_key(candidates, self.artists, "artist_id"), "tracks", ["track_id"])

    @cached_property
    def tracks(self) -> DataFrame:
        return self._staged("tracks", sound(self._judged_tracks))

    @cached_property
    def _referenced_streams(self) -> DataFrame:
        referenced = referenced_streams(self._bronze.streams, self.listeners, self.tracks)
        return self._staged("referenced_streams", referenced)

    @cached_property
    def _judged_streams(self) -> DataFrame:
        candidates = schemas.conform(self._referenced_streams.where("_orphan is null"), schemas.SILVER["streams"])
        return judged(candidates, "streams", ["stream_id"], self._staged)

    @cached_property
    def streams(self) -> DataFrame:
        return self._staged("streams", sound(self._judged_streams))

    @cached_property
    def rejected_records(self) -> DataFrame:
        logged = reduce(DataFrame.unionByName, [
            *self._bronze.unreadable,
            tracks_without_artist(self._bronze.tracks, self.artists),
            streams_without_reference(self._referenced_streams),
            refused(self._judged_listeners, "listeners", "listener_id"),
            refused(self._judged_artists, "artists", "artist_id"),
            refused(self._judged_tracks, "tracks", "track_id"),
            refused(self._judged_streams, "streams", "stream_id"),
        ])
        numbered = logged.select(
            (F.monotonically_increasing_id() + 1).alias("id"),
            "*",
            F.lit(self._rejected_at).cast("timestamp").alias("rejected_at"),
        )
        return self._staged("rejected_records", numbered)

    def starting_from(self, **tables: DataFrame) -> Silver:
        """Take tables that exist already instead of deriving them."""
        vars(self).update(tables)
        return self

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schemas.SILVER}


class GivenSilver(Silver):
    """Silver tables that exist already."""

    def __init__(self, **tables: DataFrame):
        vars(self).update(tables)


def read(store: LayerStore) -> Silver:
    return GivenSilver(**{name: store.read(LAYER, name, ddl) for name, ddl in schemas.SILVER.items()})


def writing(store: LayerStore, bronze: Bronze, rejected_at: str) -> Silver:
    """The layer, each table written on first use, before the next ones read it."""
    def stage(name: str, df: DataFrame) -> DataFrame:
        layer = LAYER if name in schemas.SILVER else f"{LAYER}_work"
        return store.replace(layer, name, df, DDL[name])

    return Silver(bronze, rejected_at, stage)
