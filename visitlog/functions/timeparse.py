"""Visit times: ``MM/dd/yyyy hh:mm`` text to timestamps and their parts.

The log's documented pattern has a 12-hour field and no AM/PM mark, so under
``clock="12h"`` hours 13-23 and 00 do not parse and 12:30 becomes 00:30. Use
``clock="24h"`` for data that really holds 24-hour times. A value that does not
parse is NULL under any ANSI or parser-policy setting of the session.
"""

from pyspark.sql import functions as F

from visitlog.operators.names import free_name

# Time patterns of the log, and the leading text that has the shape
# of a time on each clock.
STRICT_PATTERNS = {"12h": "MM/dd/yyyy hh:mm", "24h": "MM/dd/yyyy HH:mm"}
TOLERANT_PATTERNS = {"12h": "M/d/yyyy h:m", "24h": "M/d/yyyy H:m"}
LEADING_TIME = {
    "12h": r"^\s*(\d{1,2}/\d{1,2}/\d{4} +(?:0?[1-9]|1[0-2]):\d{1,2})(?!\d)",
    "24h": r"^\s*(\d{1,2}/\d{1,2}/\d{4} +(?:[01]?\d|2[0-3]):\d{1,2})(?!\d)",
}


def parse_visit_ts(c, clock="12h", tolerant=True):
    """Timestamp of a visit-time string, NULL where it does not parse.

    ``tolerant`` reads what Spark 2's parser read: unpadded fields, leading and
    several spaces, anything but a digit after the minutes. Years need four digits. Text without a
    time on this clock is NULL before it reaches the parser, as a failed parse
    costs several times a good one.
    """
    c = F.col(c) if isinstance(c, str) else c
    if tolerant:
        found = F.regexp_extract(c, LEADING_TIME[clock], 1)
        c = F.nullif(F.regexp_replace(found, " +", " "), F.lit(""))
    pattern = (TOLERANT_PATTERNS if tolerant else STRICT_PATTERNS)[clock]
    return F.try_to_timestamp(c, F.lit(pattern))


def with_time_parts(df, ts, year=None, month=None, hour=None):
    """Append integer parts of timestamp expression ``ts`` under the names given."""
    parts = [(year, F.year), (month, F.month), (hour, F.hour)]
    moment = free_name(df.columns, "_ts")
    return (
        df.withColumn(moment, ts)
        .select(*df.columns, *[part(moment).alias(name) for name, part in parts if name])
    )


def minutes_between(start, end):
    """Whole minutes from ``start`` to ``end``; negative if ``end`` comes first."""
    return F.timestamp_diff("MINUTE", start, end)
