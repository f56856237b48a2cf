"""All layers from raw files to views, written below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunelake.plans import bronze as bronze_plan
from tunelake.plans import gold as gold_plan
from tunelake.plans import reports, serving
from tunelake.plans import silver as silver_plan
from tunelake.plans.bronze import Bronze
from tunelake.plans.gold import Calendar, Gold
from tunelake.plans.silver import Silver
from tunelake.session import require_utc
from tunelake.sources.layers import LayerStore


def layers(store: LayerStore, raw: Bronze, run_at: str, calendar: Calendar) -> tuple[Bronze, Silver, Gold]:
    """Bronze, silver and gold; a table is written when it, or one that builds on it, is first used."""
    bronze = bronze_plan.writing(store, raw)
    silver = silver_plan.writing(store, bronze, run_at)
    return bronze, silver, gold_plan.writing(store, silver, calendar)


def write_layers(store: LayerStore, raw: Bronze, run_at: str, calendar: Calendar) -> tuple[Bronze, Silver, Gold]:
    """The same, with every table written at once."""
    written = layers(store, raw, run_at, calendar)
    for layer in written:
        layer.tables()
    written[2].listener_tracks  # the roll-up is written on first use, like any table
    return written


# Views that the summary is made of, and that the reports show as well.
SUMMARY_VIEWS = ["v_year_in_review_summary", "v_listening_personality", "v_top_genre_by_listener"]


def run(
    spark: SparkSession, raw_dir: str, out_dir: str, run_at: str, calendar: Calendar = Calendar(),
    json_lines: bool = False, report_limit: int | None = None,
) -> Gold:
    """Load raw files, write every layer, register the views and export the reports.

    The exports share views, so the shared ones are written first: those of the summary, and all that
    the reports show unless only a few listeners are wanted.
    """
    require_utc(spark)
    store = LayerStore(spark, out_dir)
    gold = write_layers(store, bronze_plan.load(spark, raw_dir, run_at, json_lines), run_at, calendar)[2]
    serving.register_views(spark, gold)
    shared = SUMMARY_VIEWS if report_limit is not None else reports.SHOWN_VIEWS
    views = {name: _written_view(store, name, gold) for name in shared}
    rows = reports.reports(gold, calendar.current_year, run_at, report_limit, views)
    reports.export_reports(rows, store.path("reports", "documents"))
    reports.export_summary_csv(
        reports.summary_extract(gold, views), store.path("reports", "year_in_review_summary")
    )
    return gold


def _written_view(store: LayerStore, name: str, gold: Gold) -> DataFrame:
    view = serving.VIEWS[name](gold)
    return store.replace("serving_work", name, view, view.schema)
