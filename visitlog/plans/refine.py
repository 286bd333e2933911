"""From the raw positional log to the stored refined table."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from visitlog.functions.predicates import equals
from visitlog.operators.counting import split_counts
from visitlog.operators.reshape import leading_columns, select_positions
from visitlog.schema import (
    RAW_WIDTH,
    REFINED_POSITIONS,
    VISITEE,
    VISITEE_POSITION,
    positional_name,
)
from visitlog.session import release, stage
from visitlog.sinks.tables import save_refined, verify_written

_VISITEE_COLUMN = positional_name(VISITEE_POSITION)


def refine(raw, visitee=VISITEE, positions=REFINED_POSITIONS, keep=()):
    """Rows for one visitee, with the columns of interest named."""
    return select_positions(raw.filter(equals(_VISITEE_COLUMN, visitee)), positions, keep)


def refine_log(raw, visitee=VISITEE):
    """:func:`refine` over the leading columns of a file of any width."""
    return refine(leading_columns(raw, RAW_WIDTH), visitee)


def refine_counts(raw, visitee=VISITEE):
    """Raw, kept and filtered-out rows."""
    return split_counts(raw, equals(_VISITEE_COLUMN, visitee))


def refine_to_table(raw, table, visitee=VISITEE, fmt="orc", compact=False, path=None):
    """Refine ``raw`` into ``table``; one row of counters, written rows included.

    The log is read once: raw and kept rows are observed in the single narrow
    stage that writes the kept ones. With ``compact`` that stage writes them to
    the shared folder, and they are rebalanced from there. ``complete`` says
    whether the table holds the kept rows, in the columns expected.
    """
    spark = raw.sparkSession
    seen, kept = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("n")
    refined = refine(raw.observe(seen, rows), visitee).observe(kept, rows)
    if compact:
        staged = []
        try:
            save_refined(stage(refined, "kept", staged), table, fmt, compact, path)
        finally:
            release(spark, staged)
    else:
        save_refined(refined, table, fmt, path=path)
    n_raw, n_kept = seen.get["n"], kept.get["n"]
    return verify_written(spark, table, n_kept, refined.schema).select(
        F.lit(n_raw).cast("long").alias("raw_rows"),
        F.lit(n_kept).cast("long").alias("kept_rows"),
        F.lit(n_raw - n_kept).cast("long").alias("filtered_out"),
        "written_rows",
        (F.col("rows_match") & F.col("schema_matches")).alias("complete"),
    )
