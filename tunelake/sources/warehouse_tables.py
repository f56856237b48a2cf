"""Raw listening records derived from order-warehouse tables (nation, customer, part, events, …).

The tables are clean, so the defects that the silver layer must handle are put in by rules on the
keys: padding, casing, missing tokens, two date formats, orphans, copies and conflicting keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.operators.lookups import by_shuffle
from tunelake.plans.bronze import RAW_FILES, Bronze
from tunelake.sources.raw_files import from_frame

# Columns read from each table.
COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp"
    ),
}
# Event types stand for devices (fixed values).
DEVICE_OF_EVENT = {
    "view": "mobile", "click": "desktop", "signup": "tablet", "error": "smart_speaker", "purchase": "web",
}
LOADED_AT = "2024-02-01T00:00:00+00:00"
#: Rows that one task stages, about.
TASK_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a table dealt out to tasks of about ``TASK_ROWS``.

    A row group is read by one task, whatever its rows, and the files that this task writes are again read by as few:
    a narrow table of millions of rows would be staged, cleaned and judged by one task each time. The rows are counted
    from the files' footers; a table of one task's rows stays as it is.
    """
    tasks = -(-df.count() // TASK_ROWS)
    return df.repartition(tasks) if tasks > 1 else df


def _padded(condition: str, value: str) -> str:
    return f"if({condition}, concat('  ', {value}, ' '), {value})"


def raw_listeners(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as listeners."""
    customers = spread(table(spark, folder, "customer")).join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    born = "date_add(DATE '1955-01-01', CAST(c_custkey * 13 % 20000 AS INT))"
    joined = (
        "date_format(timestamp_seconds(unix_timestamp(TIMESTAMP '2018-01-01 00:00:00') "
        "+ c_custkey * 17 % 2000 * 86400 + c_custkey % 86400), \"yyyy-MM-dd'T'HH:mm:ss\")"
    )
    return customers.selectExpr(
        "concat('usr_', c_custkey) AS listener_id",
        "concat('User', c_custkey, '@Example.com') AS email",
        _padded("c_custkey % 50 = 0", "concat('user', c_custkey)") + " AS username",
        _padded("c_custkey % 50 = 0", "split_part(c_name, '#', 1)") + " AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        f"CASE WHEN c_custkey % 40 = 7 THEN 'None' WHEN c_custkey % 97 = 5 THEN 'unknown' "
        f"ELSE CAST({born} AS STRING) END AS birth_date",
        "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '   ' WHEN c_custkey % 13 = 0 THEN 'None' "
        "ELSE concat(' City ', n_name) END AS city",
        "n_name AS country",
        "CASE WHEN c_custkey % 101 = 50 THEN 'trial' WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN ' Premium ' "
        "ELSE 'free' END AS subscription_type",
        f"{joined} AS created_at",
    )


def raw_artists(spark: SparkSession, folder: str) -> DataFrame:
    """Brands as artists; the genre is the type of the brand's first part."""
    brands = table(spark, folder, "part").groupBy("p_brand").agg(F.min_by("p_type", "p_partkey").alias("kind"))
    return brands.selectExpr("p_brand", "kind", "CAST(split_part(p_brand, '#', 2) AS INT) AS number").selectExpr(
        "concat('art_', lpad(number, greatest(3, length(number)), '0')) AS artist_id",
        _padded("number % 10 = 0", "p_brand") + " AS name",
        "CASE number % 5 WHEN 0 THEN lower(kind) WHEN 1 THEN concat(' ', kind) ELSE kind END AS genre",
        "concat('NATION_', number) AS country",
        "if(number % 7 = 0, 'None', CAST(1950 + number * 2 AS STRING)) AS formed_year",
        "CAST(number * number * number * number * 3 AS STRING) AS monthly_listeners",
    )


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as tracks."""
    released = "date_add(DATE '1990-01-01', CAST(p_partkey * 7 % 12000 AS INT))"
    number = "split_part(p_brand, '#', 2)"
    artist = f"if(p_partkey % 90 = 89, 'art_999', concat('art_', lpad({number}, greatest(3, length({number})), '0')))"
    return spread(table(spark, folder, "part")).selectExpr(
        "concat('trk_', p_partkey) AS track_id",
        _padded("p_partkey % 50 = 0", "p_name") + " AS title",
        _padded("p_partkey % 30 = 3", artist) + " AS artist_id",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 17 = 4 THEN 'None' WHEN p_partkey % 19 = 5 THEN '' "
        "ELSE concat(p_name, ' LP') END AS album",
        "CAST(p_size * 10000 AS STRING) AS duration_ms",
        _padded("p_partkey % 50 = 2", "if(p_partkey % 10 = 0, lower(p_type), p_type)") + " AS genre",
        f"CASE WHEN p_partkey % 333 = 40 THEN 'not-a-date' "
        f"WHEN p_partkey % 50 = 1 THEN date_format({released}, 'MM/dd/yyyy') "
        f"ELSE CAST({released} AS STRING) END AS release_date",
        "CASE p_partkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN '1' ELSE 'False' END AS explicit",
    )


def raw_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Events as streams, some of them loaded twice."""
    device = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{d}'" for e, d in DEVICE_OF_EVENT.items()) + " END"
    streams = spread(table(spark, folder, "events")).selectExpr(
        "concat('str_', event_id) AS stream_id",
        "if(event_id % 250 = 17, 'usr_unknown', " + _padded("event_id % 50 = 0", "concat('usr_', user_id)")
        + ") AS listener_id",
        "concat('trk_', CAST(get_json_object(props, '$.k') AS BIGINT) + if(event_id % 200 = 0, 1000000, 0)) AS track_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS streamed_at",
        "CASE event_id % 700 WHEN 11 THEN '-5' WHEN 12 THEN '4000000' "
        "ELSE CAST(CAST(round(value * 1000) AS BIGINT) AS STRING) END AS duration_played_ms",
        f"if(event_id % 500 = 123, 'console', {_padded('event_id % 50 = 3', device)}) AS device_type",
        "if(event_id % 3 = 0, 'True', 'False') AS shuffle_mode",
        "if(event_id % 10 = 0, '1', 'False') AS offline_mode",
        # Once as it is, and again for copies and for rows that contradict their own id.
        "explode(concat(array(0), if(event_id % 100 = 0, array(1), array()), if(event_id % 997 = 5, array(2), array()))) "
        "AS _load",
    )
    return streams.withColumn(
        "duration_played_ms", F.expr("if(_load = 2, '1', duration_played_ms)")
    ).drop("_load")


def bronze(spark: SparkSession, folder: str) -> Bronze:
    """The four raw inputs staged as bronze."""
    raw = {"listeners": raw_listeners, "artists": raw_artists, "tracks": raw_tracks, "streams": raw_streams}
    return Bronze(lambda entity: from_frame(raw[entity](spark, folder), entity, RAW_FILES[entity], LOADED_AT))


def order_line_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as clean streams of several years: customers play the parts they bought.

    Lines have no key of their own, so ``stream_id`` is not unique here.
    """
    orders = by_shuffle(table(spark, folder, "orders"))
    lines = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    devices = ", ".join(f"'{device}'" for device in DEVICE_OF_EVENT.values())
    return lines.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS stream_id",
        "concat('usr_', o_custkey) AS listener_id",
        "concat('trk_', l_partkey) AS track_id",
        "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT)) AS streamed_at",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS duration_played_ms",
        f"element_at(array({devices}), CAST(l_orderkey % 5 + 1 AS INT)) AS device_type",
        "if(l_returnflag = 'R', 1, 0) AS shuffle_mode",
        "if(l_linestatus = 'O', 1, 0) AS offline_mode",
    )
