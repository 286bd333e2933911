"""Small summaries for charts over the export.

The log's documentation names these charts and gives no queries; signs, bin
widths and tie-breaks are this package's choice.
"""

from pyspark.sql import functions as F

from visitlog.functions.timeparse import minutes_between, parse_visit_ts
from visitlog.operators.counting import group_counts, group_shares
from visitlog.schema import EXPORT_PARTS


def monthly_visits(export, year="visit_year", month="visit_month"):
    """Rows per month. Rows without a time form one group."""
    return group_counts(export, [year, month])


def hour_month_heat(export):
    """Rows per hour of day and month of year."""
    return group_counts(export, ["visit_hour", "visit_month"])


def location_share(visits, column="meeting_location"):
    """Rows per location and their percentage of all rows."""
    return group_shares(visits, [column])


def arrival_gap_hist(visits, clock="12h", width=15):
    """Rows per bin of minutes from appointment to arrival (early is negative).

    A bin is named by its lower end. Rows with a time missing are left out.
    """
    gap = minutes_between(
        parse_visit_ts("appt_scheduled_time", clock), parse_visit_ts("time_of_arrival", clock)
    )
    bins = visits.select((F.floor(gap / width) * width).alias("gap_bin"))
    # Counting the bin itself gives 0 for the group without one. A filter on the
    # bin would move below the grouping and parse both times of each row again.
    counts = bins.groupBy("gap_bin").agg(F.count("gap_bin").alias("count"))
    return counts.filter(F.col("count") > 0)


def time_counts(cleaned, keys=EXPORT_PARTS, clock="12h"):
    """Visits per group of time parts, with what a mean arrival gap needs.

    Columns ``count``, ``gap_sum`` and ``gap_rows`` can be summed over groups.
    """
    year, month, hour = EXPORT_PARTS
    arrival = F.col("_arrival")
    return (
        cleaned.select(
            parse_visit_ts("time_of_arrival", clock).alias("_arrival"),
            parse_visit_ts("appt_scheduled_time", clock).alias("_scheduled"),
        )
        .select(
            F.year(arrival).alias(year),
            F.month(arrival).alias(month),
            F.hour(arrival).alias(hour),
            minutes_between("_scheduled", "_arrival").alias("_gap"),
        )
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("_gap").alias("gap_sum"),
            F.count("_gap").alias("gap_rows"),
        )
    )


def kpis_of(months):
    """The KPIs from rows of :func:`time_counts` per year and month."""
    year, month, _ = EXPORT_PARTS
    # Most visits first, then the earlier month.
    rank = F.when(F.col(month).isNotNull(), F.struct("count", -F.col(year), -F.col(month)))
    peak = F.max_by(F.struct(year, month, "count"), rank)
    return months.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_visits"),
        peak[year].alias("peak_year"),
        peak[month].alias("peak_month"),
        peak["count"].alias("peak_visits"),
        F.round(F.try_divide(F.sum("gap_sum"), F.sum("gap_rows")), 4).alias("avg_gap_minutes"),
    )


def visit_kpis(cleaned, clock="12h"):
    """All visits, the month with most of them, and the mean arrival gap.

    Months are counted first, so one small row per month and task is shuffled;
    the totals and the peak come from those rows.
    """
    return kpis_of(time_counts(cleaned, EXPORT_PARTS[:2], clock))
