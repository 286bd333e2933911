"""A visits log derived from the ``events`` table.

Each column follows one rule on ``event_id``, ``user_id``, ``ts`` or
``event_type``, so the frame grows with the table and holds NULLs, empty and
blank text, spelling variations, ties and 24-hour times.
"""

from visitlog.schema import (
    RAW_WIDTH,
    REFINED_POSITIONS,
    VISITEE_POSITION,
    positional_name,
)

# The rules of the derived log.
COLUMN_RULES = {
    "event_id": "event_id",
    "lname": "IF(event_id % 97 = 0, NULL, 'L' || user_id % 40)",
    "fname": "IF(event_id % 89 = 0, '  ', 'F' || user_id % 7)",
    "time_of_arrival": """CASE WHEN event_id % 11 = 0 THEN NULL
        WHEN event_id % 13 = 0 THEN '   '
        ELSE date_format(ts, 'MM/dd/yyyy HH:mm') END""",
    "appt_scheduled_time": """IF(event_id % 17 = 0, NULL,
        date_format(date_trunc('hour', ts + INTERVAL 30 MINUTES), 'MM/dd/yyyy HH:mm'))""",
    "meeting_location": """CASE WHEN event_id % 19 = 0 THEN NULL
        WHEN event_id % 10 < 7 THEN 'WH' ELSE 'OEOB' END""",
    "visitee": """CASE event_type WHEN 'purchase' THEN 'POTUS' WHEN 'error' THEN 'potus'
        ELSE upper(event_type) END""",
    "info_comment": """CASE event_id % 12 WHEN 0 THEN NULL WHEN 1 THEN ''
        WHEN 2 THEN 'GEN RECEP' WHEN 3 THEN 'General Reception' WHEN 4 THEN 'gen. recep 2'
        WHEN 5 THEN 'GENERAL  RECEPTION/' WHEN 6 THEN 'OPERATIONS' WHEN 7 THEN '   '
        ELSE 'TOUR ' || event_id % 23 END""",
}


EMPTY = "''"


def visits_from_events(events):
    """Named log columns plus ``event_id`` (unique) and ``visitee``."""
    return events.selectExpr(*[f"{rule} AS {name}" for name, rule in COLUMN_RULES.items()])


def as_positional(visits, keep=(), width=RAW_WIDTH):
    """The raw headerless layout of named visits; unused positions are empty."""
    names = {**REFINED_POSITIONS, VISITEE_POSITION: "visitee"}
    return visits.selectExpr(
        *keep, *[f"{names.get(i, EMPTY)} AS {positional_name(i)}" for i in range(width)]
    )
