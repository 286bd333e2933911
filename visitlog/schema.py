"""Column layout of the visitor log."""

from pyspark.sql import types as T

# These must equal the published log layout for right results.
VISITEE = "POTUS"
VISITEE_POSITION = 19
RAW_WIDTH = 26
REFINED_POSITIONS = {
    0: "lname",
    1: "fname",
    6: "time_of_arrival",
    11: "appt_scheduled_time",
    21: "meeting_location",
    25: "info_comment",
}
EXPORT_PARTS = ("visit_year", "visit_month", "visit_hour")
REQUIRED_FOR_EXPORT = ("lname", "fname", "time_of_arrival", "info_comment")
RECEPTION_PATTERN = "GEN.*RECEP|GENERAL.*RECEPTION"
SAMPLE_COLUMNS = ("fname", "lname", "time_of_arrival", "meeting_location")
PAGE_SIZE = 1000

REFINED_COLUMNS = tuple(REFINED_POSITIONS.values())


def positional_name(position):
    """Name Spark gives the column at ``position`` of a headerless file."""
    return f"_c{position}"


def positional_schema(width=RAW_WIDTH):
    """``width`` nullable string columns named ``_c0`` onwards.

    Declaring the width keeps a short first line from deciding it.
    """
    return T.StructType(
        [T.StructField(positional_name(i), T.StringType()) for i in range(width)]
    )


def refined_schema():
    return T.StructType([T.StructField(n, T.StringType()) for n in REFINED_COLUMNS])


def export_schema():
    return T.StructType(
        refined_schema().fields
        + [T.StructField(n, T.IntegerType()) for n in EXPORT_PARTS]
    )
