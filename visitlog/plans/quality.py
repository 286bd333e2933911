"""Missing values and cleaning."""

from pyspark.sql import functions as F

from visitlog.functions.predicates import (
    all_of,
    is_empty,
    matches,
    not_blank,
    not_null,
)
from visitlog.operators.counting import counted, percent, split_counts
from visitlog.operators.reshape import preview
from visitlog.schema import RECEPTION_PATTERN, REQUIRED_FOR_EXPORT, SAMPLE_COLUMNS


def missing_purpose_rate(visits, column="info_comment", weight=None):
    """Visits without a purpose (NULL or empty) and their percentage."""
    missing = counted(is_empty(column), weight)
    return visits.agg(
        missing.alias("missing_count"),
        percent(missing, counted(weight=weight)).alias("percent"),
    )


def missing_purpose_sample(visits, k=10, order_by=None, column="info_comment"):
    """``k`` visitors without a purpose; give ``order_by`` for a repeatable choice."""
    return preview(visits.filter(is_empty(column)), k, order_by).select(*SAMPLE_COLUMNS)


def _is_clean(visits, required, complete):
    complete = visits.columns if complete is None else complete
    return all_of(not_blank, required) & all_of(not_null, complete)


def clean(visits, required=REQUIRED_FOR_EXPORT, complete=None):
    """Rows with text in every ``required`` column and no NULL in ``complete``
    (by default in any column)."""
    return visits.filter(_is_clean(visits, required, complete))


def clean_counts(visits, required=REQUIRED_FOR_EXPORT, complete=None):
    """Rows in all, rows that :func:`clean` keeps, and rows it removes."""
    return split_counts(
        visits, _is_clean(visits, required, complete), "total_rows", "clean_rows", "removed_rows"
    )


def visit_profile(visits, columns, column="info_comment", pattern=RECEPTION_PATTERN):
    """All single-row counters of the log in one scan."""
    exported = _is_clean(visits, REQUIRED_FOR_EXPORT, columns)
    return visits.agg(
        counted().alias("total_rows"),
        F.count_if(~all_of(not_null, columns)).alias("null_rows"),
        F.count_if(is_empty(column)).alias("missing_purpose"),
        F.count_if(matches(column, pattern)).alias("variations"),
        F.count_if(exported).alias("clean_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
