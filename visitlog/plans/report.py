"""All questions about one log, by name."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from visitlog.functions.predicates import not_empty
from visitlog.operators.counting import group_counts, null_counts, null_profile, null_row_counts
from visitlog.operators.ranking import least_frequent, most_frequent
from visitlog.plans import analyses, dashboards, export, quality


def analysis_results(visits, clock="12h"):
    """The eight analyses; some give a figure and a list. Each is a scan of its own."""
    return {
        "first_visitor": analyses.first_visitor(visits, clock),
        "last_visitor": analyses.last_visitor(visits, clock),
        "top_comments": analyses.top_comments(visits),
        "least_comments": analyses.least_comments(visits),
        "variation_rate": analyses.variation_rate(visits),
        "variation_values": analyses.variation_values(visits),
        "top_visitors": analyses.top_visitors(visits),
        "null_rows": null_row_counts(visits),
        "null_counts": null_counts(visits),
        "missing_purpose_rate": quality.missing_purpose_rate(visits),
        "missing_purpose_sample": quality.missing_purpose_sample(visits, order_by=visits.columns),
    }


@contextmanager
def shared_analysis_results(visits, clock="12h"):
    """The same results for a caller that wants them all.

    Five of them depend on purposes only. They are taken from one grouping of the
    log by purpose, kept until the ``with`` block ends; the label pattern then
    runs once per distinct text. The first and last visitor share one scan, and
    so do the NULL figures.
    """
    purposes = group_counts(visits, ["info_comment"]).persist()
    ends = analyses.first_and_last_visitor(visits, clock).persist()
    nulls = null_profile(visits).persist()
    given = purposes.filter(not_empty("info_comment"))
    try:
        yield analysis_results(visits, clock) | {
            "first_visitor": ends.filter("earliest IS NOT NULL").select("earliest.*"),
            "last_visitor": ends.filter("latest IS NOT NULL").select("latest.*"),
            "top_comments": most_frequent(given, "info_comment"),
            "least_comments": least_frequent(given, "info_comment"),
            "variation_rate": analyses.variation_rate(purposes, weight="count"),
            "variation_values": analyses.variation_values(purposes),
            "null_rows": nulls.select("total_rows", "clean_rows", "null_rows", "percent_null"),
            "null_counts": nulls.select(*visits.columns),
            "missing_purpose_rate": quality.missing_purpose_rate(purposes, weight="count"),
        }
    finally:
        for kept in (purposes, ends, nulls):
            kept.unpersist()


def chart_results(visits, clock="12h"):
    """The chart summaries over the cleaned log."""
    cleaned = quality.clean(visits)
    exported = export.add_visit_parts(cleaned, clock)
    return {
        "monthly_visits": dashboards.monthly_visits(exported),
        "hour_month_heat": dashboards.hour_month_heat(exported),
        "top_visitors": analyses.top_visitors(exported),
        "location_share": dashboards.location_share(exported),
        "arrival_gap_hist": dashboards.arrival_gap_hist(exported, clock),
        "top_comments": analyses.top_comments(exported),
        "visit_kpis": dashboards.visit_kpis(cleaned, clock),
    }


@contextmanager
def shared_chart_results(visits, clock="12h"):
    """The same charts for a caller that wants them all.

    The three about months and hours come from one grouping by year, month and
    hour, kept until the ``with`` block ends.
    """
    hours = dashboards.time_counts(quality.clean(visits), clock=clock).persist()

    def per(*keys):
        sums = [F.sum(c).alias(c) for c in ("count", "gap_sum", "gap_rows")]
        return hours.groupBy(*keys).agg(*sums)

    months = per("visit_year", "visit_month")
    try:
        yield chart_results(visits, clock) | {
            "monthly_visits": months.drop("gap_sum", "gap_rows"),
            "hour_month_heat": per("visit_hour", "visit_month").drop("gap_sum", "gap_rows"),
            "visit_kpis": dashboards.kpis_of(months),
        }
    finally:
        hours.unpersist()
