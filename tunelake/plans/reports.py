"""Year-in-review reports: one nested document per listener, and a flat summary of all of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.plans import serving
from tunelake.plans.gold import Gold

# View, and the columns a report shows of it. The first column of a list section is its sort key.
OBJECT_SECTIONS = {
    "summary": ("v_year_in_review_summary", [
        "total_streams", "total_minutes", "total_hours", "days_active", "unique_tracks", "unique_artists",
        "unique_genres", "avg_completion_pct", "full_plays", "full_play_rate", "shuffle_pct", "offline_pct",
        "listening_percentile",
    ]),
    "top_genre": ("v_top_genre_by_listener", [
        "top_genre", "stream_count", "minutes_listened", "genre_share_pct",
    ]),
    "listening_personality": ("v_listening_personality", [
        "listening_personality", "total_streams", "unique_artists", "unique_tracks", "unique_genres", "shuffle_pct",
        "full_play_pct",
    ]),
    "weekday_vs_weekend": ("v_weekday_vs_weekend", [
        "weekday_streams", "weekend_streams", "weekday_minutes", "weekend_minutes", "listener_type",
    ]),
}
LIST_SECTIONS = {
    "top_artists": ("v_top_artists_by_listener", "artist_rank", [
        "artist_rank", "artist_name", "artist_genre", "stream_count", "minutes_listened",
    ]),
    "top_tracks": ("v_top_tracks_by_listener", "track_rank", [
        "track_rank", "track_title", "artist_name", "album", "play_count", "minutes_listened",
    ]),
    "monthly_trends": ("v_monthly_trends_by_listener", "month", [
        "month", "month_name", "streams", "unique_tracks", "unique_artists", "minutes_listened", "hours_listened",
    ]),
    "peak_listening_times": ("v_peak_listening_times", "time_rank", [
        "time_of_day", "stream_count", "pct_of_listening", "time_rank",
    ]),
}
# Order of the sections in a document (fixed values).
SECTION_ORDER = [
    "summary", "top_artists", "top_tracks", "top_genre", "listening_personality", "monthly_trends",
    "peak_listening_times", "weekday_vs_weekend",
]
SHOWN_VIEWS = [part[0] for part in [*OBJECT_SECTIONS.values(), *LIST_SECTIONS.values()]]
SUMMARY_COLUMNS = [
    "listener_id", "listener_name", "subscription_type", "country", "total_streams", "total_hours", "unique_artists",
    "unique_tracks", "unique_genres", "full_play_rate", "listening_percentile", "listening_personality", "top_genre",
]


# --- sections ----------------------------------------------------------------------------------------

def section(gold: Gold, name: str, listener_ids: DataFrame | None = None) -> DataFrame:
    """Rows of one report section: ``listener_id`` and the section's columns.

    With ``listener_ids`` the plays of other listeners are dropped before anything is aggregated. The
    summary compares a listener with all others, so it is restricted afterwards.
    """
    view, *_, columns = OBJECT_SECTIONS.get(name) or LIST_SECTIONS[name]
    if listener_ids is None:
        rows = serving.VIEWS[view](gold)
    elif name == "summary":
        rows = serving.VIEWS[view](gold).join(listener_ids, "listener_id", "left_semi")
    else:
        rows = serving.VIEWS[view](gold.for_listeners(listener_ids))
    return rows.select("listener_id", *columns)


def listener_section(gold: Gold, name: str, listener_id: str, limit: int | None = None) -> DataFrame:
    """One section of one listener, in reading order, cut to its first ``limit`` ranks if given."""
    one = gold.dim_listener.where(F.col("listener_id") == listener_id).select("listener_id")
    rows = section(gold, name, one)
    if name not in LIST_SECTIONS:
        return rows
    _, sort_key, _ = LIST_SECTIONS[name]
    if limit is not None:
        rows = rows.where(F.col(sort_key) <= limit)
    return rows.orderBy(sort_key)


# --- documents ---------------------------------------------------------------------------------------

def _as_object(rows: DataFrame, name: str) -> DataFrame:
    _, columns = OBJECT_SECTIONS[name]
    return rows.select("listener_id", F.struct(*columns).alias(name))


def _as_list(rows: DataFrame, name: str) -> DataFrame:
    """Gather a section's rows per listener: a handful of ranks, months or times of day each."""
    _, sort_key, columns = LIST_SECTIONS[name]
    keyed = F.sort_array(F.collect_list(F.struct(F.col(sort_key).alias("_order"), F.struct(*columns).alias("_row"))))
    return rows.groupBy("listener_id").agg(F.transform(keyed, lambda entry: entry["_row"]).alias(name))


def reports(
    gold: Gold, year: int, generated_at: str, limit: int | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per listener with the sections as nested columns.

    ``limit`` keeps the first listeners by id, and computes no more than their sections. ``views``
    may hold views that are already written, to read instead of computing them again.
    """
    listeners = gold.dim_listener.select(
        "listener_id", F.col("full_name").alias("listener_name"), "email", "country", "subscription_type"
    )
    wanted = None
    if limit is not None:
        listeners = listeners.orderBy("listener_id").limit(limit)
        wanted = listeners.select("listener_id")

    def rows(name: str) -> DataFrame:
        view, *_, columns = OBJECT_SECTIONS.get(name) or LIST_SECTIONS[name]
        if views is not None and view in views:
            shown = views[view] if wanted is None else views[view].join(wanted, "listener_id", "left_semi")
            return shown.select("listener_id", *columns)
        return section(gold, name, wanted)

    sections = [
        _as_object(rows(name), name) if name in OBJECT_SECTIONS else _as_list(rows(name), name)
        for name in SECTION_ORDER
    ]
    joined = reduce(lambda left, right: left.join(right, "listener_id", "left"), sections, listeners)
    return joined.select(
        "listener_id", "listener_name", "email", "country", "subscription_type",
        F.lit(year).alias("year"),
        F.lit(generated_at).alias("generated_at"),
        *(F.coalesce(name, F.array()).alias(name) if name in LIST_SECTIONS else F.col(name) for name in SECTION_ORDER),
    )


def _json(column: Column) -> Column:
    return F.to_json(column, {"ignoreNullFields": "false"})


def report_documents(report_rows: DataFrame) -> DataFrame:
    """Each report as JSON text. Missing values stay as ``null``; a missing section is ``{}`` or ``[]``."""
    identity = [name for name in report_rows.columns if name not in SECTION_ORDER]
    head = _json(F.struct(*identity))
    members = [
        F.concat(F.lit(f',"{name}":'), F.coalesce(_json(F.col(name)), F.lit("{}"))) for name in SECTION_ORDER
    ]
    document = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), *members, F.lit("}"))
    return report_rows.select("listener_id", document.alias("document"))


# --- exports -----------------------------------------------------------------------------------------

def export_reports(report_rows: DataFrame, path: str) -> int:
    """Write one JSON document per line and listener; returns the number of documents."""
    report_documents(report_rows).select("document").write.mode("overwrite").text(path)
    return report_rows.sparkSession.read.text(path).count()


def summary_extract(gold: Gold, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Summary, personality and top genre side by side, a line per listener; ``views`` as for the reports."""
    def rows(view: str) -> DataFrame:
        return views[view] if views is not None and view in views else serving.VIEWS[view](gold)

    personality = rows("v_listening_personality").select("listener_id", "listening_personality")
    genre = rows("v_top_genre_by_listener").select("listener_id", "top_genre")
    return (
        rows("v_year_in_review_summary")
        .join(personality, "listener_id", "left")
        .join(genre, "listener_id", "left")
        .select(*SUMMARY_COLUMNS)
    )


def export_summary_csv(summary: DataFrame, path: str) -> int:
    """Write the summary as CSV with a header, longest listening first; without rows nothing is written."""
    if summary.isEmpty():
        return 0
    ordered = summary.orderBy(F.desc("total_hours"), F.asc("listener_id"))
    ordered.write.mode("overwrite").option("header", True).csv(path)
    written = summary.sparkSession.read.schema(summary.schema).option("header", True).csv(path)
    return written.count()
