"""Row numbers and fixed-size pages over a whole frame.

A ``row_number()`` over one window would move all rows into one task. Here the
rows keep the partitions that Spark gave them: each row stores its partition
and its place in it (both are in ``monotonically_increasing_id``), rows per
partition are counted from that one stored column, and a running total of those
counts gives each partition its offset.
"""

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from visitlog.operators.names import free_name
from visitlog.schema import PAGE_SIZE
from visitlog.session import release, stage

# monotonically_increasing_id keeps the place within a partition in these bits.
PLACE_BITS = 33


class NotUnique(ValueError):
    """Rows agree on columns that were said to tell them apart."""


def number_rows(df, order_by=None, unique=False, name="row_number", staged=None):
    """Append a gapless 1-based number as a long.

    ``order_by`` lists columns (sorted ascending, NULLs first). Without it rows
    are numbered as stored, and no row is shuffled.

    Unless ``unique`` says that no two rows agree on ``order_by``, the rows get
    a stored tie-break first. The range sort can then split a run of equal keys
    over many tasks, even if it is a third of all rows. ``unique`` is checked in the
    sorted partitions as they are written, equal keys being neighbours in one of them:
    :class:`NotUnique` is raised if it is wrong, as numbers would depend on chance. It
    saves the stored tie-break where all of ``order_by`` are names.

    The numbered rows read staged copies in the shared folder, whose paths are
    added to the list ``staged``; once the rows are written elsewhere,
    ``release(spark, staged)`` deletes the copies.
    """
    spark, columns, made = df.sparkSession, df.columns, []
    tie, place, partition, count, offset, nth = [
        free_name([*columns, name], n) for n in ("_tie", "_place", "_partition", "_rows", "_offset", "_nth")
    ]
    unique = unique and order_by and all(isinstance(c, str) for c in order_by)
    seen = Observation()
    try:
        ties = []
        if order_by:
            keys = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
            if not unique:
                df = stage(df.withColumn(tie, F.monotonically_increasing_id()), "ties", made)
                ties = list(made)
                keys.append(F.col(tie))
            df = df.orderBy(*keys).select(*[F.col(f"`{c}`") for c in columns])
            if unique:
                # The sort has put equal keys next to each other: no further shuffle.
                same = Window.partitionBy(*order_by).orderBy(*order_by)
                df = df.withColumn(nth, F.row_number().over(same))
                df = df.observe(seen, F.max(nth).alias("most")).drop(nth)
        placed = stage(df.withColumn(place, F.monotonically_increasing_id()), "placed", made)
        if unique and (seen.get["most"] or 0) > 1:
            raise NotUnique(f"{seen.get['most']} rows agree on {', '.join(order_by)}")
        if ties:
            made.remove(ties[0])
            release(spark, ties)
        part = F.shiftrightunsigned(place, PLACE_BITS).alias(partition)
        within = F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

        # One row per task of the write above, so the window is bounded by the number
        # of tasks in a job. Stored, the offsets have a size that Spark knows before
        # it plans the join: it broadcasts them below its threshold, else it shuffles.
        before = Window.orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)
        offsets = stage(
            placed.groupBy(part)
            .agg(F.count(F.lit(1)).alias(count))
            .select(partition, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(offset)),
            "offsets",
            made,
        )
    except Exception:
        release(spark, made)
        raise
    if staged is not None:
        staged += made
    return (
        placed.withColumn(partition, part)
        .join(offsets, partition)
        .select(*[F.col(f"`{c}`") for c in columns], (F.col(offset) + within + 1).alias(name))
    )


def assign_batches(df, order_by=None, size=PAGE_SIZE, unique=False, staged=None):
    """Append the page layout of a sheet whose first row is the header.

    ``sheet_row`` is the row's place on the sheet, ``batch_id`` its page from 0
    and ``start_row`` the sheet row where that page starts. Page 0 holds the
    header and ``size - 1`` rows.
    """
    number = free_name(df.columns, "_number")
    numbered = number_rows(df, order_by, unique, number, staged)
    batch = F.expr(f"{number} div {int(size)}")
    return numbered.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col(number) + 1).alias("sheet_row"),
        batch.alias("batch_id"),
        (batch * size + 1).alias("start_row"),
    )
