"""Streams that arrive in several loads: each rewrites the months it touches, and no others.

The months are found from the load itself: those of its streams, and those of earlier streams that share an id with
them, as both are refused then. All that is kept per stream (clean, with what is wrong with its references and the
hash of its record) lies in one folder per month, as do the silver streams, the fact and the daily aggregates. A
load adds its streams to the touched months, judges these months anew and replaces their folders by Spark's dynamic
partition overwrite. A load that was cut short may be run again: records that are there already are copies.

After any number of loads, in any order, the tables equal those of one load of all records. Streams without a
readable time lie in month 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake import schemas
from tunelake.functions import dates
from tunelake.operators.dedup import repeated_keys, with_shared_keys
from tunelake.operators.lookups import by_shuffle, having_key
from tunelake.plans import gold as gold_plan
from tunelake.plans import silver as silver_plan
from tunelake.plans.gold import MONTH_FOLDER, Gold
from tunelake.plans.silver import Silver
from tunelake.sources.layers import LayerStore, gathered

LAYER = "reload"
_STREAM = schemas.SILVER["streams"]
_KEPT = f"{_STREAM}, _stream_id string, _orphan string, _row_hash string, {MONTH_FOLDER} int"
_MONTHLY = {
    "streams": f"{_STREAM}, {MONTH_FOLDER} int",
    "fact_streams": schemas.GOLD["fact_streams"].replace("stream_key bigint, ", "") + f", {MONTH_FOLDER} int",
    **{name: f"{schemas.GOLD[name]}, {MONTH_FOLDER} int" for name in (
        "agg_daily_listener_streams", "agg_daily_track_streams", "agg_monthly_genre_streams",
    )},
}


def _by_month(df: DataFrame, month, ddl: str) -> DataFrame:
    return gathered(schemas.conform(df.withColumn(MONTH_FOLDER, month.cast("int")), ddl), MONTH_FOLDER)


class MonthlyLoads:
    """The event tables of a star whose listeners, artists and tracks are given."""

    def __init__(self, store: LayerStore, silver: Silver, gold: Gold):
        self._store, self._silver, self._gold = store, silver, gold

    def load(self, raw_streams: DataFrame) -> list[int]:
        """Add bronze streams; the months that were rewritten."""
        store = self._store
        records = raw_streams.select(*schemas.RAW_FIELDS["streams"], "_row_hash").distinct()
        known = silver_plan.with_references(records, self._silver.listeners, self._silver.tracks, "_row_hash")
        month = F.coalesce(F.floor(dates.date_key(F.col("streamed_at")) / 100), F.lit(0))
        added = store.replace(LAYER, "added", _by_month(known, month, _KEPT), _KEPT)
        months, rows, elsewhere = added.select(MONTH_FOLDER), added, None
        if store.exists(LAYER, "kept"):
            kept = store.read(LAYER, "kept", _KEPT)
            months = months.unionByName(having_key(kept, by_shuffle(added), "stream_id").select(MONTH_FOLDER))
        touched = sorted(row[0] for row in months.distinct().collect())  # a row per month
        if not touched:
            return []
        if store.exists(LAYER, "kept"):
            rows = rows.unionByName(kept.where(F.col(MONTH_FOLDER).isin(touched))).distinct()
            rows = store.replace(LAYER, "touched", gathered(rows, MONTH_FOLDER), _KEPT)
            elsewhere = kept.where(~F.col(MONTH_FOLDER).isin(touched))
        self._replace("streams", self._sound(rows, elsewhere), F.col(MONTH_FOLDER), touched)
        self._aggregate(touched)
        # Last, so that a load that was cut short begins anew.
        store.replace_folders(LAYER, "kept", gathered(rows, MONTH_FOLDER), _KEPT, MONTH_FOLDER, touched)
        return touched

    def _sound(self, rows: DataFrame, elsewhere: DataFrame | None) -> DataFrame:
        """The streams of the touched months that break no rule and share their id with no other stream."""
        candidates = rows.where("_orphan is null").withColumn("_broken", silver_plan.broken_rule("streams"))
        passed = candidates.where("_broken is null").select("stream_id")
        if elsewhere is not None:
            others = elsewhere.where("_orphan is null").where(silver_plan.broken_rule("streams").isNull())
            passed = passed.unionByName(having_key(others, by_shuffle(passed), "stream_id").select("stream_id"))
        shared = self._store.replace(LAYER, "shared", repeated_keys(passed, "stream_id"), "stream_id string")
        flagged = with_shared_keys(candidates, {"stream_id": shared})
        return flagged.where("_broken is null and _shared_stream_id is null")

    def _aggregate(self, months: list[int]) -> None:
        gold, tracks = self._gold, by_shuffle(self._gold.dim_track)
        streams = self.table("streams").where(F.col(MONTH_FOLDER).isin(months))
        fact = gold_plan.fact_streams(streams, gold.dim_listener, gold.dim_track, gold.dim_device, gold.dim_date)
        day_month = F.floor(F.col("date_key") / 100)
        fact = self._replace("fact_streams", fact, day_month, months).where(F.col(MONTH_FOLDER).isin(months))
        for name, counted, month in (
            ("agg_daily_listener_streams", gold_plan.agg_daily_listener_streams(fact, tracks), day_month),
            ("agg_daily_track_streams", gold_plan.agg_daily_track_streams(fact), day_month),
            ("agg_monthly_genre_streams", gold_plan.agg_monthly_genre_streams(fact, tracks, gold.dim_date),
             F.col("year") * 100 + F.col("month")),
        ):
            self._replace(name, counted, month, months)

    def _replace(self, name: str, df: DataFrame, month, months: list[int]) -> DataFrame:
        ddl = _MONTHLY[name]
        return self._store.replace_folders(LAYER, name, _by_month(df, month, ddl), ddl, MONTH_FOLDER, months)

    def table(self, name: str) -> DataFrame:
        """A table as all loads have left it, with its month folder."""
        return self._store.read(LAYER, name, _MONTHLY[name])

    def rejected(self) -> DataFrame:
        """What has been refused so far: ``source_table, source_id, rejection_reason``."""
        kept = self._store.read(LAYER, "kept", _KEPT)
        candidates = schemas.conform(kept.where("_orphan is null"), _STREAM)
        judged = silver_plan.judged(candidates, "streams", ["stream_id"])
        return silver_plan.streams_without_reference(kept).unionByName(
            silver_plan.refused(judged, "streams", "stream_id")
        )
