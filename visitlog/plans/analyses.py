"""Who came first and last, who came most, and what for."""

from pyspark.sql import functions as F

from visitlog.functions.predicates import matches, not_blank, not_empty
from visitlog.functions.text import joined
from visitlog.functions.timeparse import parse_visit_ts
from visitlog.operators.counting import match_rate
from visitlog.operators.ranking import (
    bottom_k_values,
    earliest,
    earliest_and_latest,
    first_distinct_values,
    latest,
    top_k_values,
)
from visitlog.schema import RECEPTION_PATTERN


def first_visitor(visits, clock="12h", require_parsed=False, tie_break=None):
    """The row with the earliest arrival.

    An arrival that is there but does not parse sorts before all others, unless
    ``require_parsed`` leaves such rows out.
    """
    return earliest(
        visits.filter(not_blank("time_of_arrival")),
        parse_visit_ts("time_of_arrival", clock),
        tie_break=tie_break,
        null_keys=not require_parsed,
    )


def last_visitor(visits, clock="12h", require_parsed=False, tie_break=None):
    """The row with the latest arrival; one that does not parse sorts last."""
    return latest(
        visits.filter(not_blank("time_of_arrival")),
        parse_visit_ts("time_of_arrival", clock),
        tie_break=tie_break,
        null_keys=not require_parsed,
    )


def first_and_last_visitor(visits, clock="12h"):
    """Both rows as structs ``earliest`` and ``latest``; one parse per visit."""
    return earliest_and_latest(
        visits.filter(not_blank("time_of_arrival")),
        F.unix_seconds(parse_visit_ts("time_of_arrival", clock).cast("timestamp_ltz")),
    )


def top_comments(visits, k=10, column="info_comment"):
    """The most frequent purposes that are not empty; a blank one counts."""
    return top_k_values(visits.filter(not_empty(column)), column, k)


def least_comments(visits, k=10, column="info_comment"):
    """The least frequent purposes that are not empty; a blank one counts."""
    return bottom_k_values(visits.filter(not_empty(column)), column, k)


def variation_rate(visits, pattern=RECEPTION_PATTERN, column="info_comment", weight=None):
    """How many rows spell a label in some way, ignoring case."""
    return match_rate(visits, matches(column, pattern), weight=weight)


def variation_values(visits, pattern=RECEPTION_PATTERN, column="info_comment", k=30):
    """The distinct spellings, first ``k`` in sort order."""
    return first_distinct_values(visits.filter(matches(column, pattern)), column, k)


def full_names(visits, first="fname", last="lname", name="visitor_full_name"):
    """Full names alone; one with a NULL part is NULL."""
    return visits.select(joined(first, last).alias(name))


def top_visitors(visits, k=20, first="fname", last="lname", name="visitor_full_name", keep_null=True):
    """The most frequent full names.

    A name with a NULL part is NULL, and all such rows form one group;
    ``keep_null=False`` leaves it out.
    """
    named = full_names(visits, first, last, name)
    if not keep_null:
        named = named.filter(F.col(name).isNotNull())
    return top_k_values(named, name, k)
