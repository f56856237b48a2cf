import os
import random

import pytest

from tests.conftest import RUN_AT, stream
from tunelake import schemas
from tunelake.operators.lookups import by_shuffle, having_key
from tunelake.plans import gold as gold_plan
from tunelake.plans.bronze import Bronze
from tunelake.plans.gold import MONTH_FOLDER, Calendar, Gold
from tunelake.plans.reload import LAYER, MonthlyLoads
from tunelake.plans.silver import Silver, with_references
from tunelake.sources import raw_files
from tunelake.sources.layers import LayerStore

TABLES = ("fact_streams", "agg_daily_listener_streams", "agg_daily_track_streams", "agg_monthly_genre_streams")


def bronze_of(spark, records):
    rows = spark.createDataFrame(
        [tuple(record[f] for f in schemas.RAW_FIELDS["streams"]) for record in records],
        ", ".join(f"{f} string" for f in schemas.RAW_FIELDS["streams"]),
    )
    return raw_files.from_frame(rows, "streams", "streams.csv", RUN_AT)


def whole(spark, layers, records):
    """All tables from one load."""
    bronze, silver, gold = layers
    given = Bronze(lambda name: bronze_of(spark, records) if name == "streams" else getattr(bronze, name))
    once = Silver(given, RUN_AT).starting_from(
        listeners=silver.listeners, artists=silver.artists, tracks=silver.tracks
    )
    star = Gold(spark, once, Calendar()).starting_from(
        **{name: getattr(gold, name) for name in ("dim_artist", "dim_listener", "dim_track", "dim_date", "dim_device")}
    )
    refused = [tuple(r)[1:4] for r in once.rejected_records.where("source_table = 'streams'").collect()]
    return {name: sorted(map(str, getattr(star, name).collect())) for name in TABLES} | {"rejected": sorted(map(str, refused))}


def found(loads):
    tables = {name: sorted(str(row) for row in loads.table(name).drop(MONTH_FOLDER).collect()) for name in TABLES}
    return tables | {"rejected": sorted(str(tuple(row)) for row in loads.rejected().collect())}


def files(store):
    return {
        os.path.join(folder, name): os.path.getmtime(os.path.join(folder, name))
        for table in TABLES for folder, _, names in os.walk(store.path(LAYER, table)) for name in names
        if name.startswith("part-")
    }


@pytest.fixture
def loads(spark, layers, tmp_path):
    return MonthlyLoads(LayerStore(spark, str(tmp_path)), layers[1], layers[2])


def test_loads_in_any_order_equal_one_load(spark, layers, loads, raw_records):
    records = list(raw_records["streams"])
    random.Random(3).shuffle(records)
    for part in (records[:30], records[25:]):
        loads.load(bronze_of(spark, part))
    assert found(loads) == whole(spark, layers, records)


def test_a_late_file_rewrites_its_months_only(spark, layers, loads):
    first = [stream(n) for n in range(60)]
    assert len(loads.load(bronze_of(spark, first))) == 12
    before = files(loads._store)
    late = [stream(100, streamed_at="2025-03-05T10:00:00"), stream(101, streamed_at="2025-03-06T11:00:00")]
    assert loads.load(bronze_of(spark, late)) == [202503]
    after = files(loads._store)
    changed = {path for path in before.keys() | after.keys() if before.get(path) != after.get(path)}
    assert changed and all("date_month=202503" in path for path in changed)
    assert found(loads) == whole(spark, layers, first + late)


def test_an_id_of_another_month_touches_that_month_too(spark, layers, loads):
    first = [stream(0, streamed_at="2025-01-05T10:00:00"), stream(1, streamed_at="2025-02-05T10:00:00")]
    loads.load(bronze_of(spark, first))
    late = [stream(0, streamed_at="2025-04-01T00:00:00")]
    assert loads.load(bronze_of(spark, late)) == [202501, 202504]
    assert found(loads) == whole(spark, layers, first + late)
    assert loads.table("fact_streams").count() == 1  # the only play of January is refused now
    more = [stream(0, streamed_at="2025-05-01T00:00:00"), stream(2, streamed_at="2025-01-07T00:00:00")]
    assert loads.load(bronze_of(spark, more)) == [202501, 202504, 202505]
    assert found(loads) == whole(spark, layers, first + late + more)


def test_nothing_new(spark, loads):
    assert loads.load(bronze_of(spark, [stream(0)]).limit(0)) == []
    assert loads.load(bronze_of(spark, [stream(0), stream(3, streamed_at="never")])) == [0, 202501]
    assert loads.load(bronze_of(spark, [stream(0)])) == [202501] and loads.table("fact_streams").count() == 1


def test_loads_are_told_apart_by_the_number_that_an_id_ends_in(spark):
    import __spark_entry__ as entry

    ids = spark.createDataFrame([("str_12",), ("  str_7 ",), ("9",), ("x",), (None,)], "stream_id string")
    assert [row[0] for row in ids.select(entry._load_number("stream_id")).collect()] == [12, 7, 9, 0, 0]


def test_no_table_that_grows_is_broadcast_by_its_text_ids(spark, layers, gold):
    """However small the tables are, only the calendar and the devices are broadcast."""
    silver = layers[1]
    known = with_references(layers[0].streams, silver.listeners, silver.tracks)
    streams = silver.streams
    fact = gold_plan.fact_streams(streams, gold.dim_listener, gold.dim_track, gold.dim_device, gold.dim_date)
    joins = {"known": known, "fact": fact, "ids": having_key(streams, by_shuffle(silver.streams), "stream_id")}
    plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in joins.items()}
    assert {name: plan.count("SortMergeJoin") for name, plan in plans.items()} == {"known": 2, "fact": 2, "ids": 1}
    assert {name: plan.count("BroadcastHashJoin") for name, plan in plans.items()} == {"known": 0, "fact": 2, "ids": 0}


def test_folders_are_replaced_by_one_pass_over_the_rows(spark, tmp_path):
    store, passed = LayerStore(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def counted(row):
        passed.add(1)
        return row

    def rows(*months):
        given = spark.sparkContext.parallelize([(n, month) for n, month in enumerate(months)], 2)
        return spark.createDataFrame(given.map(counted), "n int, month int")

    store.replace_folders("layer", "t", rows(1, 1, 2, 3), "n int, month int", "month", [1, 2, 3])
    assert passed.value == 4
    left = store.replace_folders("layer", "t", rows(2, 2), "n int, month int", "month", [1, 2])
    assert passed.value == 6 and sorted(row.month for row in left.collect()) == [2, 2, 3]
