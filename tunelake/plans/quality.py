"""Cross-layer checks. Every check is one row ``check_name, status, observed, expected``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions import text
from tunelake.operators.dedup import repeated_hashes
from tunelake.operators.lookups import lacking_key
from tunelake.plans import serving
from tunelake.plans.bronze import Bronze
from tunelake.plans.gold import Gold
from tunelake.plans.silver import Silver

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"
# A play longer than this is suspicious.
LONGEST_PLAY_MS = 3_600_000


def _row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _check(name: str, figures: DataFrame, observed: Column, expected: Column, otherwise: str = FAIL) -> DataFrame:
    """A check that passes when observed equals expected. ``figures`` holds a single row."""
    return figures.select(
        F.lit(name).alias("check_name"),
        F.when(observed == expected, PASS).otherwise(otherwise).alias("status"),
        observed.cast("bigint").alias("observed"),
        expected.cast("bigint").alias("expected"),
    )


def _zero(name: str, counted: DataFrame) -> DataFrame:
    return _check(name, counted, F.col("n"), F.lit(0))


def _not_empty(name: str, counted: DataFrame, otherwise: str = FAIL) -> DataFrame:
    """Passes for at least one row; ``observed`` is the row count, ``expected`` its lower bound."""
    return counted.select(
        F.lit(name).alias("check_name"),
        F.when(F.col("n") > 0, PASS).otherwise(otherwise).alias("status"),
        F.col("n").alias("observed"),
        F.lit(1).cast("bigint").alias("expected"),
    )


def _scalar(df: DataFrame) -> Column:
    """The single value of a one-row, one-column frame, as part of another query."""
    return df.scalar()


def layers_present(bronze: Bronze, silver: Silver, gold: Gold) -> list[DataFrame]:
    return [
        _not_empty("bronze is readable and has rows", _row_count(bronze.streams)),
        _not_empty("silver is readable and has rows", _row_count(silver.streams)),
        _not_empty("gold is readable and has rows", _row_count(gold.fact_streams)),
    ]


def silver_checks(silver: Silver) -> list[DataFrame]:
    # Repeated rows per id, so that the hottest id is merged before the shuffle.
    copies = silver.streams.groupBy("stream_id").agg((F.count("*") - 1).alias("surplus"))
    surplus = copies.agg(F.coalesce(F.sum("surplus"), F.lit(0)).alias("n"))
    return [
        _zero("no stream id occurs twice in silver", surplus),
        _not_empty("rejected records are logged", _row_count(silver.rejected_records), WARN),
    ]


def star_checks(silver: Silver, gold: Gold) -> list[DataFrame]:
    fact = gold.fact_streams
    kept = _check(
        "every silver stream is in the fact", _row_count(fact), F.col("n"), _scalar(_row_count(silver.streams))
    )
    dimensions = {
        "listener_key": gold.dim_listener, "track_key": gold.dim_track, "device_key": gold.dim_device,
        "date_key": gold.dim_date,
    }
    orphans = [
        # Keys are reduced to one row each before they are looked up.
        _zero(
            f"every {key} of the fact exists",
            lacking_key(fact.groupBy(key).agg(F.count("*").alias("plays")), dimension, key)
            .agg(F.coalesce(F.sum("plays"), F.lit(0)).alias("n")),
        )
        for key, dimension in dimensions.items()
    ]
    return [kept, *orphans]


def aggregate_checks(gold: Gold) -> list[DataFrame]:
    aggregates = ["agg_daily_listener_streams", "agg_daily_track_streams", "agg_monthly_genre_streams"]
    plays = _scalar(_row_count(gold.fact_streams))
    return [
        _check(
            f"{name} adds up to the fact",
            getattr(gold, name).agg(F.coalesce(F.sum("stream_count"), F.lit(0)).alias("n")),
            F.col("n"), plays,
        )
        for name in aggregates
    ]


def calendar_checks(gold: Gold, days: int = 365) -> list[DataFrame]:
    covered = gold.dim_date.agg(F.countDistinct("date_key").alias("n"))
    played = gold.fact_streams.select("date_key").distinct()
    return [
        _check(f"the calendar has {days} days", covered, F.col("n"), F.lit(days)),
        _zero("every day played is in the calendar", _row_count(lacking_key(played, gold.dim_date, "date_key"))),
    ]


def calendar_span(gold: Gold) -> DataFrame:
    """The calendar's days beside the days that were played on; both sides are one row."""
    days = gold.dim_date.agg(
        F.count("*").alias("days"), F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day")
    )
    played = gold.fact_streams.groupBy("date_key").agg(F.count("*").alias("plays")).agg(
        F.min("date_key").alias("first_played"), F.max("date_key").alias("last_played"),
        F.count("*").alias("days_played"), F.coalesce(F.sum("plays"), F.lit(0)).alias("plays"),
    )
    return played.select(*(days.select(name).scalar().alias(name) for name in days.columns), *played.columns)


def view_checks(views: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Both checks come from one count of each view."""
    expected = F.lit(len(serving.VIEWS)).cast("bigint")

    def line(name: str, observed: Column, otherwise: str) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.when(observed == expected, PASS).otherwise(otherwise).alias("status"),
            observed.alias("observed"),
            expected.alias("expected"),
        )

    counted = row_counts(views).agg(
        F.count("*").alias("present"), F.sum(F.when(F.col("row_count") > 0, 1).otherwise(0)).alias("filled")
    )
    lines = F.array(
        line("all serving views exist", F.col("present"), FAIL),
        line("all serving views have rows", F.col("filled"), WARN),
    )
    return [counted.select(F.inline(lines))]


def quality_report(bronze: Bronze, silver: Silver, gold: Gold, calendar_days: int = 365) -> DataFrame:
    """All seventeen checks."""
    views = {name: view(gold) for name, view in serving.VIEWS.items()}
    checks = (
        layers_present(bronze, silver, gold) + silver_checks(silver) + star_checks(silver, gold)
        + aggregate_checks(gold) + calendar_checks(gold, calendar_days) + view_checks(views)
    )
    return reduce(DataFrame.unionByName, checks)


def verdict(report: DataFrame) -> DataFrame:
    """Passed, failed and warned checks; warnings do not fail the data."""
    def counted(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, 1).otherwise(0)), F.lit(0))

    return report.agg(
        counted(PASS).alias("passed"), counted(FAIL).alias("failed"), counted(WARN).alias("warnings")
    ).withColumn("all_passed", F.when(F.col("failed") == 0, 1).otherwise(0))


# --- row counts and reconciliation -------------------------------------------------------------------

def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def reconciliation(bronze: Bronze, silver: Silver) -> DataFrame:
    """Bronze streams = silver streams + rejected streams + copies removed."""
    rejected = silver.rejected_records.where(F.col("source_table") == "streams")
    return _row_count(bronze.streams).select(
        F.col("n").alias("bronze"),
        _scalar(_row_count(silver.streams)).alias("silver"),
        _scalar(_row_count(rejected)).alias("rejected"),
    ).withColumn("deduplicated", F.col("bronze") - F.col("silver") - F.col("rejected"))


def rejections_by_table(silver: Silver) -> DataFrame:
    return silver.rejected_records.groupBy("source_table").agg(F.count("*").alias("rejected"))


def common_rejections(silver: Silver, limit: int = 10) -> DataFrame:
    """The most frequent reasons; ties by text."""
    counted = silver.rejected_records.groupBy("rejection_reason").agg(F.count("*").alias("occurrences"))
    return counted.orderBy(F.desc("occurrences"), F.asc("rejection_reason")).limit(limit)


def suspicious_plays(bronze: Bronze) -> DataFrame:
    """Raw streams with a negative or implausibly long duration."""
    played = text.whole_number(F.col("duration_played_ms"))
    return bronze.streams.where((played < 0) | (played > LONGEST_PLAY_MS))


def duplicate_records(bronze: Bronze) -> DataFrame:
    return repeated_hashes(bronze.streams)


def short_top_lists(gold: Gold, limit: int = serving.TOP_ROWS) -> DataFrame:
    """Listeners with fewer top artists than a full list has."""
    return (
        serving.top_artists_by_listener(gold, limit)
        .groupBy("listener_id")
        .agg(F.count("*").alias("artist_count"))
        .where(F.col("artist_count") < limit)
    )
