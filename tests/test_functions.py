import hashlib
import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tunelake.functions import classify, dates, numbers, text
from tunelake.functions.row_hash import json_text, record_text, row_hash


def values(spark, kind, cells, expression):
    """The expression for each cell, in order."""
    rows = [(i, cell) for i, cell in enumerate(cells)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").orderBy("i")
    return [row.y for row in df.select(expression(F.col("x")).alias("y")).collect()]


def test_known_text(spark):
    cells = [None, "None", "", "  ", " a ", "b"]
    assert values(spark, "string", cells, text.known_text) == [None, None, None, None, "a", "b"]


def test_capitalised(spark):
    cells = ["Hip Hop", "R&B", " ROCK ", "jazz", "", None, "k-POP"]
    assert values(spark, "string", cells, text.capitalised) == ["Hip hop", "R&b", "Rock", "Jazz", "", None, "K-pop"]


def test_flag(spark):
    cells = ["True", " true ", "1", "TRUE", "False", "0", "yes", None, ""]
    assert values(spark, "string", cells, text.flag) == [1, 1, 1, 1, 0, 0, 0, 0, 0]


def test_whole_number(spark):
    assert values(spark, "string", ["12", " 7 ", "-3", "x", "", None], text.whole_number) == [12, 7, -3, None, None, None]


def test_labelled_keeps_a_missing_value_readable(spark):
    assert values(spark, "string", ["a", None], lambda c: text.labelled("Bad: ", c)) == ["Bad: a", "Bad: <null>"]


def test_mixed_date(spark):
    cells = ["2020-01-31", "03/04/2021", "13/04/2021", "2020-02-30", "2020-13-01", "soon", None, "2020-1-1",
             "2020-01-31T10:00:00", "2020-01-31 10:00", "2020-00-10"]
    expected = [date(2020, 1, 31), date(2021, 3, 4), None, date(2020, 3, 1), None, None, None, None,
                date(2020, 1, 31), date(2020, 1, 31), None]
    assert values(spark, "string", cells, dates.mixed_date) == expected


def test_event_time_is_cut_to_seconds(spark):
    cells = ["2025-03-01T10:11:12.987654", "2025-03-01 10:11:12", "junk", None]
    shown = values(spark, "string", cells, lambda c: dates.event_time(c).cast("string"))
    assert shown == ["2025-03-01 10:11:12", "2025-03-01 10:11:12", None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_have_one_shape_and_do_not_depend_on_the_zone(spark, zone):
    cells = ["10:15:00", "2024", "2024-01", "2024-1-5", "2024-02-30T10:00:00", "2020-01-01T23:30:00-05:00",
             "2025-03-09T02:30:00", "2024-01-05", "2024-01-05T25:00:00", "2024-01-05 10:61", "2024-01-05T10:11Z "]
    expected = [None, None, None, None, "2024-03-01 10:00:00", "2020-01-02 04:30:00", "2025-03-09 02:30:00",
                "2024-01-05 00:00:00", None, None, "2024-01-05 10:11:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = values(spark, "string", cells, lambda c: F.unix_timestamp(dates.event_time(c)))
        days = values(spark, "string", cells, lambda c: dates.iso_date(c).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shown = [s if s is None else datetime.fromtimestamp(s, timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for s in seconds]
    assert shown == expected
    assert days == [e and e[:10] for e in expected]


def test_nearly_all_shapes_are_read_from_fixed_places(spark, monkeypatch):
    """Patterns and casts that fail cost many times the rest; only odd texts may need them."""
    monkeypatch.setattr(dates, "_any_seconds", lambda text: F.raise_error(F.lit("searched for parts")).cast("bigint"))
    cells = ["2025-03-01T10:11:12.987654", "2025-03-01T10:11:12.5Z", "2025-03-01 10:11:12Z", "2025-03-01", "2025-02-30T23:59:59.9"]
    shown = values(spark, "string", cells, lambda c: dates.event_time(c).cast("string"))
    assert shown == ["2025-03-01 10:11:12"] * 3 + ["2025-03-01 00:00:00", "2025-03-02 23:59:59"]
    assert values(spark, "string", ["", "07"], dates._digits) == [0, 7]


def test_a_number_beyond_the_column_is_null(spark):
    assert values(spark, "string", ["99999999999"], lambda c: text.whole_number(c).try_cast("int")) == [None]


def test_calendar_fields_agree_with_strftime(spark):
    days = [date(2019, 1, 1) + timedelta(days=n) for n in range(3653)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", dates.monday_week_number(F.col("d")).alias("week"), dates.sunday_based_weekday(F.col("d")).alias("weekday"),
        dates.date_key(F.col("d")).alias("key"), dates.is_weekend(F.col("d")).alias("weekend"),
        dates.is_fixed_holiday(F.col("d")).alias("holiday"),
    ).collect()
    for row in rows:
        assert row.week == int(row.d.strftime("%W")) + 1
        assert row.weekday == int(row.d.strftime("%w"))
        assert row.key == int(row.d.strftime("%Y%m%d"))
        assert row.weekend == int(row.weekday in (0, 6))
        assert row.holiday == int(row.d.strftime("%m-%d") in ("01-01", "07-04", "11-11", "12-25"))


def test_months_until_is_cut_towards_zero(spark):
    cells = ["2025-11-30 12:00:00", "2025-12-31 00:00:00", "2026-02-05 00:00:00", "2024-12-31 00:00:00"]
    got = values(spark, "string", cells, lambda c: dates.months_until(c.cast("timestamp"), "2025-12-31"))
    assert got == [1, 0, -1, 11]


def test_age_groups_change_at_their_bounds(spark):
    years = [None, 17.99, 18, 24.99, 25, 34.99, 35, 44.99, 45, 54.99, 55, 90]
    assert values(spark, "double", [None if y is None else float(y) for y in years], classify.age_group) == [
        "Unknown", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+"]


def test_popularity_tiers_change_at_their_bounds(spark):
    cells = [0, 9_999, 10_000, 99_999, 100_000, 999_999, 1_000_000]
    assert values(spark, "bigint", cells, classify.popularity_tier) == [
        "emerging", "emerging", "established", "established", "star", "star", "superstar"]


def test_duration_buckets_change_at_their_bounds(spark):
    cells = [179_999, 180_000, 300_000, 300_001]
    assert values(spark, "bigint", cells, classify.duration_bucket) == ["short", "medium", "medium", "long"]


def test_every_hour_has_a_band(spark):
    hours = [f"2025-01-01 {h:02d}:30:00" for h in range(24)]
    bands = values(spark, "string", hours, lambda c: classify.time_of_day(c.cast("timestamp")))
    assert bands == (["Late Night"] * 5 + ["Early Morning"] * 4 + ["Morning"] * 3 + ["Midday"] * 3
                     + ["Afternoon"] * 3 + ["Evening"] * 3 + ["Night"] * 3)


@pytest.mark.parametrize("figures, expected", [
    ((100, 80, 1, 100, 100, 100), "Explorer"),
    ((100, 79, 3, 100, 100, 100), "Genre Loyalist"),
    ((100, 79, 4, 71, 100, 100), "The Shuffler"),
    ((100, 79, 4, 70, 86, 100), "Deep Listener"),
    ((100, 79, 4, 70, 85, 51), "Offline Adventurer"),
    ((2501, 79, 4, 0, 0, 0), "Power User"),
    ((2500, 79, 4, 0, 0, 0), "Casual Listener"),
])
def test_the_first_personality_rule_wins(spark, figures, expected):
    columns = [F.lit(figure) for figure in figures]
    label = classify.personality(*columns, classify.PersonalityRules())
    assert spark.range(1).select(label.alias("y")).first().y == expected


def test_week_habit(spark):
    df = spark.createDataFrame([(100, 40), (100, 41), (0, 0)], "weekday int, weekend int")
    labels = [r.y for r in df.select(classify.week_habit(F.col("weekday"), F.col("weekend")).alias("y")).collect()]
    assert labels == ["Weekday Listener", "Weekend Warrior", "Weekday Listener"]


def test_played_percent_needs_a_length(spark):
    df = spark.createDataFrame([(90, 100), (5, 0), (250, 100)], "played bigint, length bigint")
    got = [r.y for r in df.select(numbers.played_percent(F.col("played"), F.col("length")).alias("y")).collect()]
    assert got == [90.0, None, 250.0]


def test_row_hash_can_be_recomputed_with_json_and_md5(spark):
    records = [
        {"b": "plain", "a": 'quote " and \\ slash'}, {"b": "naïve ☃ 😀", "a": "tab\tline\n"}, {"b": "", "a": "None"},
    ]
    df = spark.createDataFrame([(r["b"], r["a"]) for r in records], "b string, a string")
    hashed = df.selectExpr(record_text({"b": json_text("b"), "a": json_text("a")}) + " AS r").selectExpr(
        row_hash("r") + " AS h"
    )
    expected = [hashlib.md5(json.dumps(r, sort_keys=True).encode()).hexdigest() for r in records]
    assert [row.h for row in hashed.collect()] == expected
