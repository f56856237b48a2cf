from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_AT
from tunelake.plans import bronze as bronze_plan
from tunelake.plans.bronze import Bronze
from tunelake.plans.silver import Silver


@pytest.fixture(scope="module")
def silver(layers):
    return layers[1]


def reasons(silver):
    rows = silver.rejected_records.collect()
    return sorted((r.source_table, r.source_id, r.rejection_reason) for r in rows)


def test_listeners_are_cleaned(silver):
    rows = {r.listener_id: r for r in silver.listeners.collect()}
    assert sorted(rows) == ["l1", "l2", "l3", "l4"]
    assert rows["l1"].email == "l1@mail.com" and rows["l1"].username == "user1"
    assert rows["l1"].birth_date == date(1990, 5, 6)
    assert [rows[i].city for i in ("l1", "l2", "l3", "l4")] == ["Oslo", None, None, None]
    assert rows["l2"].subscription_type == "free"
    assert rows["l2"].birth_date is None and rows["l3"].birth_date is None


def test_artists_and_tracks_are_cleaned(silver):
    artists = {r.artist_id: r for r in silver.artists.collect()}
    assert [artists[f"art_00{n}"].genre for n in (1, 2, 3)] == ["Hip hop", "R&b", "Pop"]
    assert artists["art_002"].formed_year is None
    tracks = {r.track_id: r for r in silver.tracks.collect()}
    assert sorted(tracks) == [f"trk_000{n}" for n in range(1, 8)]
    assert tracks["trk_0006"].release_date == date(2021, 3, 4) and tracks["trk_0006"].album == "Best"
    assert tracks["trk_0006"].explicit == 1 and tracks["trk_0001"].explicit == 0


def test_streams_lose_copies_orphans_and_conflicts(silver):
    ids = sorted(r.stream_id for r in silver.streams.collect())
    assert ids == [f"str_{n:06d}" for n in [*range(60), 64, 65, 68]]


def test_every_refusal_is_logged_once_with_its_reason(silver):
    assert reasons(silver) == sorted([
        ("listeners", "l5", "Unknown subscription_type"),
        ("listeners", "l6", "Duplicate listener_id: l6"), ("listeners", "l6", "Duplicate listener_id: l6"),
        ("tracks", "trk_0008", "Invalid artist_id: art_999"),
        ("tracks", "trk_0009", "Missing or unreadable release_date"),
        ("streams", "str_000060", "Invalid track_id: trk_0008"),
        ("streams", "str_000061", "Invalid track_id: trk_7777"),
        ("streams", "str_000062", "Invalid listener_id: l5"),
        ("streams", "str_000063", "Invalid track_id: nothing"),
        ("streams", "str_000066", "Duplicate stream_id: str_000066"),
        ("streams", "str_000066", "Duplicate stream_id: str_000066"),
        ("streams", "str_000067", "Missing or unreadable duration_played_ms"),
    ])
    rows = silver.rejected_records.collect()
    assert len({r.id for r in rows}) == len(rows)
    assert {str(r.rejected_at) for r in rows} == {"2026-01-02 03:04:05"}


def test_more_copies_and_another_partitioning_change_nothing(spark, raw_dir, silver):
    raw = bronze_plan.load(spark, raw_dir, RUN_AT)
    doubled = Bronze(lambda name: getattr(raw, name).unionByName(getattr(raw, name)).repartition(5))
    again = Silver(doubled, RUN_AT)
    assert sorted(again.streams.collect()) == sorted(silver.streams.collect())
    assert sorted(again.tracks.collect()) == sorted(silver.tracks.collect())
    streams_only = [r for r in reasons(again) if r[0] == "streams"]
    assert streams_only == [r for r in reasons(silver) if r[0] == "streams"]


def test_a_missing_reference_is_refused(spark, layers):
    from tunelake import schemas
    from tunelake.plans.silver import streams_without_reference, with_references
    fields = schemas.RAW_FIELDS["streams"]
    raw = spark.createDataFrame(
        [("s1", None), ("s2", "trk_0001"), ("s3", " trk_0001 ")], "stream_id string, track_id string"
    ).select("*", *(F.lit("l1" if c == "listener_id" else None).alias(c) for c in fields[1:] if c != "track_id"))
    rows = streams_without_reference(with_references(raw, layers[1].listeners, layers[1].tracks)).collect()
    assert [(r.source_id, r.rejection_reason) for r in rows] == [("s1", "Invalid track_id: <null>")]


def test_bronze_streams_are_read_once(spark, raw_dir, layers):
    """The streams, the shared ids and the refused records start from one table that is written once."""
    written = []
    silver = Silver(bronze_plan.load(spark, raw_dir, RUN_AT), RUN_AT, lambda name, df: written.append((name, df)) or df)
    silver.starting_from(**{name: getattr(layers[1], name) for name in ("listeners", "artists", "tracks")})
    silver.streams, silver.rejected_records
    names = [name for name, _ in written]
    assert names.count("referenced_streams") == 1
    plan = dict(written)["referenced_streams"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [stream_id") == 1
