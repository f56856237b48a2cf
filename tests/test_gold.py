import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_AT
from tunelake import schemas
from tunelake.operators.surrogate import with_dense_key
from tunelake.plans import bronze as bronze_plan
from tunelake.plans import exploration, serving
from tunelake.plans import gold as gold_plan
from tunelake.plans.gold import Calendar, Gold
from tunelake.sources.layers import LayerStore


def test_dense_keys_are_a_gapless_numbering_that_ignores_partitioning(spark):
    ids = [f"id{n}" for n in range(5000)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    keys = {r.id: r.k for r in with_dense_key(df, "id", "k").collect()}
    assert sorted(keys.values()) == list(range(1, 5001))
    again = {r.id: r.k for r in with_dense_key(df.repartition(11), "id", "k").collect()}
    assert again == keys


def test_calendar(gold):
    rows = gold.dim_date.orderBy("date_key").collect()
    assert len(rows) == 365 and rows[0].date_key == 20250101 and rows[-1].date_key == 20251231
    first, fourth = rows[0], rows[184]
    assert (first.month_name, first.day_name, first.is_holiday, first.quarter, first.week_of_year) == (
        "January", "Wednesday", 1, 1, 1)
    assert (str(fourth.full_date), fourth.is_holiday, fourth.day_name) == ("2025-07-04", 1, "Friday")


def test_dimensions_carry_derived_columns(gold):
    artists = {r.artist_id: r for r in gold.dim_artist.collect()}
    assert [artists[f"art_00{n}"].popularity_tier for n in (1, 2, 3)] == ["emerging", "established", "superstar"]
    assert artists["art_001"].years_active == 25 and artists["art_002"].years_active is None
    listeners = {r.listener_id: r for r in gold.dim_listener.collect()}
    assert listeners["l1"].full_name == "Ann No1" and listeners["l1"].age_group == "25-34"
    assert listeners["l2"].age_group == "Unknown" and listeners["l1"].tenure_months == 23
    tracks = {r.track_id: r for r in gold.dim_track.collect()}
    assert tracks["trk_0006"].release_year == 2021 and tracks["trk_0006"].duration_bucket == "medium"
    assert tracks["trk_0001"].artist_key == artists["art_002"].artist_key
    assert [(r.device_key, r.device_category) for r in gold.dim_device.orderBy("device_key").collect()] == [
        (1, "mobile"), (2, "mobile"), (3, "desktop"), (4, "desktop"), (5, "other")]


def test_fact_leaves_out_unknown_devices_and_other_years(gold, layers):
    rows = {r.stream_id: r for r in gold.fact_streams.collect()}
    assert len(rows) == 61 and "str_000064" not in rows and "str_000065" not in rows
    left_out = gold_plan.unplaced_streams(layers[1].streams, gold.dim_device, gold.dim_date).collect()
    assert sorted(map(tuple, left_out)) == [
        ("str_000064", "Unknown device_type: toaster"), ("str_000065", "Outside calendar: 20241231")]
    assert len({r.stream_key for r in rows.values()}) == len(rows)


def test_fact_measures(gold):
    rows = {r.stream_id: r for r in gold.fact_streams.collect()}
    full = rows["str_000009"]                     # 180,000 of 200,000 ms
    assert (full.duration_played_pct, full.is_full_play, full.date_key) == (90.0, 1, 20251010)
    short = rows["str_000008"]                    # 160,000 of 200,000 ms
    assert (short.duration_played_pct, short.is_full_play) == (80.0, 0)
    no_length = rows["str_000006"]                # trk_0007 has no length
    assert (no_length.duration_played_pct, no_length.is_full_play) == (0.0, 0)


def test_full_play_uses_the_unrounded_share(spark, gold):
    days = gold.dim_date
    streams = spark.createDataFrame(
        [("a", "l1", "t", "2025-01-01 00:00:00", 89_996, "web", 0, 0), ("b", "l1", "t", "2025-01-01 00:00:00", 90_000, "web", 0, 0)],
        "stream_id string, listener_id string, track_id string, streamed_at string, duration_played_ms bigint, "
        "device_type string, shuffle_mode int, offline_mode int",
    ).withColumn("streamed_at", F.col("streamed_at").cast("timestamp"))
    tracks = spark.createDataFrame([("t", 1, 100_000)], "track_id string, track_key bigint, duration_ms bigint")
    fact = gold_plan.fact_streams(streams, gold.dim_listener, tracks, gold.dim_device, days)
    assert {r.stream_id: (r.duration_played_pct, r.is_full_play) for r in fact.collect()} == {
        "a": (90.0, 0), "b": (90.0, 1)}


def test_aggregates_agree_with_a_plain_count(gold):
    plays = gold.fact_streams.join(gold.dim_track, "track_key").join(gold.dim_date, "date_key").collect()

    def grouped(*keys):
        groups = {}
        for p in plays:
            groups.setdefault(tuple(p[k] for k in keys), []).append(p)
        return groups

    daily = {(r.date_key, r.listener_key): r for r in gold.agg_daily_listener_streams.collect()}
    expected = grouped("date_key", "listener_key")
    assert daily.keys() == expected.keys()
    for key, rows in expected.items():
        got = daily[key]
        assert (got.stream_count, got.unique_tracks, got.unique_artists, got.full_plays, got.shuffle_streams) == (
            len(rows), len({p.track_key for p in rows}), len({p.artist_key for p in rows}),
            sum(p.is_full_play for p in rows), sum(p.shuffle_mode for p in rows))
    monthly = {(r.year, r.month, r.genre): r for r in gold.agg_monthly_genre_streams.collect()}
    expected = grouped("year", "month", "genre")
    assert monthly.keys() == expected.keys()
    for key, rows in expected.items():
        got = monthly[key]
        assert (got.stream_count, got.unique_listeners, got.unique_tracks, got.total_duration_ms) == (
            len(rows), len({p.listener_key for p in rows}), len({p.track_key for p in rows}),
            sum(p.duration_played_ms for p in rows))


def test_lazy_and_written_stars_are_equal(spark, layers, gold):
    lazy = Gold(spark, layers[1], Calendar())
    for name, table in lazy.tables().items():
        columns = [c for c in schemas.names_of(schemas.GOLD[name]) if c != "stream_key"]
        assert sorted(table.select(*columns).collect(), key=str) == sorted(
            getattr(gold, name).select(*columns).collect(), key=str), name


def test_loading_into_the_same_folder_again_replaces_the_tables(spark, raw_dir, layers, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for _ in range(2):
        bronze_plan.writing(store, bronze_plan.load(spark, raw_dir, RUN_AT)).tables()
    stored = bronze_plan.read(store)
    for name, table in layers[0].tables().items():
        assert sorted(getattr(stored, name).collect(), key=str) == sorted(table.collect(), key=str)


def test_a_written_star_can_be_read_back(layers, gold):
    store = LayerStore(gold.dim_date.sparkSession, gold.dim_date.inputFiles()[0].split("/gold/")[0])
    stored = gold_plan.read(store)
    assert stored.fact_streams.count() == gold.fact_streams.count()
    assert sum(r.streams for r in stored.listener_tracks.collect()) == gold.fact_streams.count()


def test_a_span_of_months_reads_only_their_folders(gold):
    spring = gold.between("2025-03-01", "2025-05-31")
    keys = {r.date_key // 100 for r in spring.fact_streams.collect()}
    assert keys == {202503, 202504, 202505}
    plan = spring.fact_streams._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan
    assert sum(r.streams for r in spring.listener_tracks.collect()) == spring.fact_streams.count()
    with pytest.raises(ValueError):
        gold.between("2025-03-02", "2025-05-31")


def test_a_part_of_a_star_obtains_only_the_tables_that_are_used(spark, gold):
    """Restricting a star must not derive, or write, aggregates that the question does not touch."""
    class Refusing(gold_plan.GivenGold):
        def __getattr__(self, name):
            raise AssertionError(f"{name} is not needed")

    whole = Refusing(fact_streams=gold.fact_streams, dim_track=gold.dim_track, dim_listener=gold.dim_listener)
    for name in ("agg_daily_listener_streams", "agg_daily_track_streams", "agg_monthly_genre_streams"):
        vars(whole)[name] = None  # used, they would fail
    spring = whole.between("2025-03-01", "2025-05-31")
    assert spring.listener_tracks.count() > 0
    one = gold.dim_listener.where("listener_id = 'l1'").select("listener_id")
    assert whole.for_listeners(one).fact_streams.select("listener_key").distinct().count() == 1


def test_a_star_without_a_written_fact_answers_alike(spark, layers, gold, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    star = gold_plan.writing(store, layers[1], Calendar(), gold_plan.UnwrittenFact).starting_from(
        **{name: getattr(gold, name) for name in ("dim_artist", "dim_listener", "dim_track", "dim_date", "dim_device")}
    )
    for question in (exploration.plays_by_age_group, serving.monthly_trends_by_listener):
        rows = sorted(map(str, question(star).collect()))
        assert rows and rows == sorted(map(str, question(gold).collect()))
    assert not store.exists(gold_plan.LAYER, "fact_streams")


def test_monthly_trends_count_each_track_and_artist_once(gold):
    plays = gold.fact_streams.join(gold.dim_track, "track_key").join(gold.dim_listener, "listener_key").collect()
    expected = {}
    for row in plays:
        expected.setdefault((row.listener_id, row.date_key // 100 % 100), []).append(row)
    found = {(r.listener_id, r.month): r for r in serving.monthly_trends_by_listener(gold).collect()}
    assert found.keys() == expected.keys()
    for key, rows in expected.items():
        assert (found[key].streams, found[key].unique_tracks, found[key].unique_artists) == (
            len(rows), len({r.track_key for r in rows}), len({r.artist_key for r in rows}))
        assert found[key].month_name == date(2025, key[1], 1).strftime("%B")
