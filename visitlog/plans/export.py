"""Cleaned rows with time parts, ready to leave Spark."""

from visitlog.functions.timeparse import parse_visit_ts, with_time_parts
from visitlog.operators.paging import assign_batches
from visitlog.operators.reshape import stringify_cells
from visitlog.plans.quality import clean
from visitlog.schema import EXPORT_PARTS, PAGE_SIZE, REFINED_COLUMNS


def add_visit_parts(visits, clock="12h", column="time_of_arrival"):
    """Append year, month and hour of arrival; NULL where it does not parse."""
    year, month, hour = EXPORT_PARTS
    return with_time_parts(visits, parse_visit_ts(column, clock), year, month, hour)


def visits_export(visits, clock="12h"):
    """Clean rows with their time parts."""
    return add_visit_parts(clean(visits, complete=REFINED_COLUMNS), clock)


def export_cells(visits, clock="12h"):
    """The export as text cells, without NULLs."""
    return stringify_cells(visits_export(visits, clock), (*REFINED_COLUMNS, *EXPORT_PARTS))


def export_batches(visits, clock="12h", order_by=None, size=PAGE_SIZE, unique=False, staged=None):
    """The export as text cells with its page layout.

    Cleaned rows are sorted and numbered first; times are parsed and cells made on
    the numbered rows, once per row. ``staged`` as for ``number_rows``.
    """
    cleaned = clean(visits, complete=REFINED_COLUMNS)
    pages = assign_batches(cleaned, order_by, size, unique, staged)
    cells = stringify_cells(add_visit_parts(pages, clock), (*REFINED_COLUMNS, *EXPORT_PARTS))
    return cells.select(*cleaned.columns, *EXPORT_PARTS, *pages.columns[len(cleaned.columns) :])
