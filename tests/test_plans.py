"""Shapes of the physical plans: what would hurt at a thousand times the data."""

import re

import pytest
from pyspark.sql import functions as F

from tunelake.operators.dedup import drop_copies
from tunelake.plans import gold as gold_plan
from tunelake.plans import serving
from tunelake.plans.gold import Gold
from tunelake.sources import warehouse_tables

WITHOUT_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("view", list(serving.VIEWS))
def test_no_view_pairs_rows_without_a_key(settings, gold, view):
    settings(**WITHOUT_BROADCAST)
    plan = plan_of(serving.VIEWS[view](gold))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "MapInPandas" not in plan


@pytest.mark.parametrize("view", list(serving.VIEWS))
def test_only_bounded_tables_are_broadcast_by_hint(settings, gold, view):
    """With automatic broadcasts off, what is left are the calendar and the devices."""
    settings(**WITHOUT_BROADCAST)
    plan = plan_of(serving.VIEWS[view](gold))
    keys = set(re.findall(r"BroadcastHashJoin \[(\w+?)#", plan))
    assert keys <= {"date_key", "device_key"}


def test_the_plays_of_a_listener_and_month_are_shuffled_once(settings, gold):
    settings(**WITHOUT_BROADCAST)
    plan = plan_of(serving.VIEWS["v_monthly_trends_by_listener"](gold)).split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(listener_key#\d+L?, month#\d+", plan)) == 1


def test_a_large_dimension_is_joined_by_shuffle(settings, spark, layers, gold):
    settings(**WITHOUT_BROADCAST)
    plan = plan_of(Gold(spark, layers[1], gold_plan.Calendar()).starting_from(
        dim_listener=gold.dim_listener, dim_track=gold.dim_track).fact_streams)
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 2


def test_a_hot_listener_and_a_hot_track_are_split_over_tasks(settings, spark, gold):
    """One listener and one track hold a third of all plays; the joins split their partitions."""
    settings(**WITHOUT_BROADCAST, **{
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    })
    ids = spark.range(0, 60_000, 1, 12)
    streams = ids.select(
        F.concat(F.lit("s"), "id").alias("stream_id"),
        F.concat(F.lit("u"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)).alias("listener_id"),
        F.concat(F.lit("t"), F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 700)).alias("track_id"),
        F.lit("2025-05-05 10:00:00").cast("timestamp").alias("streamed_at"),
        F.lit(50_000).cast("bigint").alias("duration_played_ms"),
        F.lit("web").alias("device_type"), F.lit(0).alias("shuffle_mode"), F.lit(0).alias("offline_mode"),
    )
    listeners = spark.range(500).select(F.concat(F.lit("u"), "id").alias("listener_id"), F.col("id").alias("listener_key"))
    tracks = spark.range(700).select(
        F.concat(F.lit("t"), "id").alias("track_id"), F.col("id").alias("track_key"),
        F.lit(100_000).cast("bigint").alias("duration_ms"),
    )
    fact = gold_plan.fact_streams(streams, listeners, tracks, gold.dim_device, gold.dim_date)
    assert len(fact.collect()) == 60_000
    assert plan_of(fact).split("Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2


def test_copies_are_merged_before_the_shuffle(spark):
    raw = spark.range(1000).selectExpr("'same' AS v", "'hash' AS _row_hash")
    plan = plan_of(drop_copies(raw, ["v"]))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_top_rows_are_cut_before_the_shuffle(gold):
    plan = plan_of(serving.top_tracks_by_listener(gold))
    assert plan.count("WindowGroupLimit") == 2 and ", Partial" in plan and ", Final" in plan


def test_only_needed_columns_are_read(gold):
    plan = plan_of(serving.peak_listening_times(gold))
    fact = next(line for line in plan.splitlines() if "FileScan" in line and "streamed_at" in line)
    assert "struct<listener_key:bigint,streamed_at:timestamp>" in fact


def test_views_read_the_fact_at_most_once(gold):
    for view, function in serving.VIEWS.items():
        plan = plan_of(function(gold))
        assert len(re.findall(r"FileScan parquet.*fact_streams", plan)) <= 1, view


@pytest.mark.parametrize("view", [v for v in serving.VIEWS if v != "v_stream_details"])
def test_windows_over_everything_see_blocks_only(gold, view):
    """A window without partitions may only run on the sums of blocks of values."""
    plan = plan_of(serving.VIEWS[view](gold))
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line) and not re.search(r"\], \[\w+#", line):
            assert "_size" in line, line[:300]


def test_the_monthly_aggregate_shuffles_plays_by_listener_once(settings, gold):
    """Pairs of a track and a listener are nearly as many as plays; they are neither grouped nor shuffled."""
    monthly = gold_plan.agg_monthly_genre_streams(gold.fact_streams, gold.dim_track, gold.dim_date)
    for line in plan_of(monthly).splitlines():
        if "Exchange hashpartitioning" in line:
            assert not ("track_key" in line and "listener_key" in line), line
    assert plan_of(monthly).count("Exchange hashpartitioning") <= 4


def test_the_daily_listener_aggregate_shuffles_plays_once(gold):
    daily = gold_plan.agg_daily_listener_streams(gold.fact_streams, gold.dim_track)
    assert plan_of(daily).count("Exchange hashpartitioning") == 1


def test_rows_of_few_row_groups_are_staged_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse_tables, "TASK_ROWS", 100)
    columns = warehouse_tables.COLUMNS["events"].split(", ")
    rows = spark.range(0, 950, 1, 1).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id AS user_id", "'view' AS event_type",
        "CAST(id AS DOUBLE) AS value", """concat('{"k": ', id, '}') AS props""",
    )
    assert rows.columns == [column.split()[0] for column in columns]
    rows.write.parquet(f"{tmp_path}/events.parquet")  # one file of one row group
    streams = warehouse_tables.raw_streams(spark, str(tmp_path))
    assert streams.rdd.getNumPartitions() == 10
    assert sorted(streams.rdd.glom().map(len).collect())[0] >= 90
    assert streams.select("stream_id").distinct().count() == 950
    few = warehouse_tables.spread(rows.limit(100))
    assert few.rdd.getNumPartitions() == 1


def test_details_shuffle_plays_before_days_and_devices_are_looked_up(settings, gold):
    settings(**WITHOUT_BROADCAST)
    plan = plan_of(serving.stream_details(gold))
    lookups = [plan.index(f"BroadcastHashJoin [{key}#") for key in ("date_key", "device_key")]
    assert max(lookups) < plan.index("Exchange hashpartitioning")


def test_details_of_an_unwritten_fact_shuffle_plays_once_by_each_id(settings, spark, layers, gold):
    settings(**WITHOUT_BROADCAST)
    star = gold_plan.UnwrittenFact(spark, layers[1], gold_plan.Calendar()).starting_from(
        **{name: getattr(gold, name) for name in ("dim_artist", "dim_listener", "dim_track", "dim_date", "dim_device")}
    )
    details = serving.stream_details(star)
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan_of(details))
    # Both sides of each join; the artists are joined to the tracks.
    assert sorted(shuffles) == sorted(["listener_id", "track_id", "artist_key"] * 2)
    rows = sorted(map(str, details.collect()))
    assert len(rows) == 61 and rows == sorted(map(str, serving.stream_details(gold).collect()))
