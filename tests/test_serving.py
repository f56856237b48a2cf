import json
from pathlib import Path

import pytest

from tests.conftest import RUN_AT
from tunelake.plans import pipeline, quality, reports, serving
from tunelake.plans.gold import GivenGold


@pytest.fixture(scope="module")
def plays(gold):
    """The star flattened, as plain rows to count by hand."""
    return (
        gold.fact_streams.join(gold.dim_listener, "listener_key").join(gold.dim_track.drop("explicit"), "track_key")
        .join(gold.dim_artist.select("artist_key", "artist_id"), "artist_key").join(gold.dim_date, "date_key").collect()
    )


def test_details_have_every_play_once(gold, plays):
    rows = serving.stream_details(gold).collect()
    assert sorted(r.stream_id for r in rows) == sorted(p.stream_id for p in plays)
    assert len(rows[0]) == 42


def test_listener_summary(gold, plays):
    for row in serving.listener_summary(gold).collect():
        mine = [p for p in plays if p.listener_id == row.listener_id]
        assert row.total_streams == len(mine)
        assert row.unique_tracks == len({p.track_id for p in mine})
        assert row.unique_artists == len({p.artist_id for p in mine})
        assert row.active_days == len({p.full_date for p in mine})
        assert row.total_ms == sum(p.duration_played_ms for p in mine)
        assert row.first_stream_date == min(p.full_date for p in mine)


def test_discovery_counts_an_artist_in_each_quarter_with_a_new_track(gold, plays):
    for row in serving.discovery_stats(gold).collect():
        mine = [p for p in plays if p.listener_id == row.listener_id]
        first = {}
        for p in sorted(mine, key=lambda p: p.streamed_at):
            first.setdefault((p.artist_id, p.track_id), p.quarter)
        for quarter in range(1, 5):
            expected = {artist for (artist, _), q in first.items() if q == quarter}
            assert row[f"q{quarter}_new_artists"] == len(expected)
        assert sum(row[f"first_q{q}_artists"] for q in range(1, 5)) == row.total_artists_played


def test_top_tracks_break_ties_by_id(gold, plays):
    rows = serving.top_tracks_by_listener(gold).collect()
    for listener in {p.listener_id for p in plays}:
        counts = {}
        for p in plays:
            if p.listener_id == listener:
                counts[p.track_id] = counts.get(p.track_id, 0) + 1
        expected = sorted(counts, key=lambda t: (-counts[t], t))[:5]
        mine = sorted((r for r in rows if r.listener_id == listener), key=lambda r: r.track_rank)
        assert [r.track_id for r in mine] == expected


def test_the_share_of_the_top_genre_is_literal_and_corrected(gold):
    for row in serving.top_genre_by_listener(gold).collect():
        assert row.genre_share_pct == 100.0 and 0 < row.genre_share_of_total_pct <= 100.0


def test_registered_views_answer_sql(spark, gold):
    assert len(serving.register_views(spark, gold)) == 15
    assert spark.sql("SELECT count(*) AS n FROM v_stream_details").first().n == 61
    ordered = serving.presented("v_daily_platform_stats", spark.table("v_daily_platform_stats")).collect()
    assert [r.full_date for r in ordered] == sorted(r.full_date for r in ordered)


def test_one_listener_needs_no_other_plays(gold):
    whole = {tuple(r) for r in serving.top_artists_by_listener(gold).collect() if r.listener_id == "l2"}
    section = reports.listener_section(gold, "top_artists", "l2", limit=2).collect()
    assert [r.artist_rank for r in section] == [1, 2]
    assert {r.artist_name for r in section} <= {r[3] for r in whole}
    assert reports.listener_section(gold, "top_genre", "l4").collect() == []


def test_exports(spark, raw_dir, tmp_path):
    pipeline.run(spark, raw_dir, str(tmp_path), RUN_AT)
    lines = [line for f in Path(tmp_path, "reports/documents").glob("part-*") for line in f.read_text().splitlines()]
    documents = {d["listener_id"]: d for d in map(json.loads, lines)}
    assert sorted(documents) == ["l1", "l2", "l3", "l4"]
    one, silent = documents["l1"], documents["l4"]
    assert list(one)[:7] == [
        "listener_id", "listener_name", "email", "country", "subscription_type", "year", "generated_at"]
    assert list(one)[7:] == reports.SECTION_ORDER
    assert one["generated_at"] == RUN_AT and one["year"] == 2025
    assert [t["track_rank"] for t in one["top_tracks"]] == [1, 2, 3, 4, 5]
    assert "album" in one["top_tracks"][0] and None in [t["album"] for t in one["top_tracks"]]
    assert [m["month"] for m in one["monthly_trends"]] == sorted(m["month"] for m in one["monthly_trends"])
    assert silent["summary"] == {} and silent["top_artists"] == [] and silent["weekday_vs_weekend"] == {}
    csv = spark.read.option("header", True).csv(str(tmp_path / "reports/year_in_review_summary"))
    assert csv.columns == reports.SUMMARY_COLUMNS and csv.count() == 3


def test_a_limit_keeps_the_first_listeners(gold):
    whole = {r.listener_id: r for r in reports.reports(gold, 2025, RUN_AT).collect()}
    some = reports.reports(gold, 2025, RUN_AT, limit=2).collect()
    assert [r.listener_id for r in sorted(some)] == ["l1", "l2"]
    assert all(r == whole[r.listener_id] for r in some)


def test_no_summary_is_written_without_rows(spark, gold, tmp_path):
    empty = spark.createDataFrame([], "listener_id string, total_hours double")
    assert reports.export_summary_csv(empty, str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()


def test_quality_report_finds_what_is_wrong(layers, gold):
    bronze, silver, _ = layers
    sound = {r.check_name: r for r in quality.quality_report(bronze, silver, gold).collect()}
    assert len(sound) == 17
    # Two streams of the fixture have no device or day, which only this check may notice.
    assert [n for n, r in sound.items() if r.status != "PASS"] == ["every silver stream is in the fact"]
    broken = GivenGold(**{
        **gold.tables(), "listener_tracks": gold.listener_tracks,
        "dim_track": gold.dim_track.where("track_id <> 'trk_0001'"),
        "dim_date": gold.dim_date.where("month <> 3"),
        "agg_daily_track_streams": gold.agg_daily_track_streams.limit(5),
    })
    checks = quality.star_checks(silver, broken) + quality.aggregate_checks(broken) + quality.calendar_checks(broken)
    failed = {r.check_name for check in checks for r in check.collect() if r.status == "FAIL"}
    assert failed == {
        "every silver stream is in the fact", "every track_key of the fact exists", "every date_key of the fact exists",
        "agg_daily_track_streams adds up to the fact", "the calendar has 365 days",
        "every day played is in the calendar"}


def test_reconciliation_accounts_for_every_row(layers):
    bronze, silver, _ = layers
    row = quality.reconciliation(bronze, silver).first()
    assert row.bronze == row.silver + row.rejected + row.deduplicated
    # Two copies, one repeated orphan.
    assert row.deduplicated == 3
