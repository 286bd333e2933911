"""Column selection and whole-row reshaping; all of it narrow."""

from pyspark.sql import functions as F

from visitlog.functions.predicates import is_null
from visitlog.functions.text import cell
from visitlog.operators.names import free_name
from visitlog.schema import positional_name


def leading_columns(df, n):
    """The first ``n`` columns."""
    return df.select(*df.columns[:n])


def select_positions(df, names_by_position, keep=()):
    """Pick positional columns and name them; ``keep`` passes others through."""
    return df.select(
        *keep,
        *[F.col(positional_name(i)).alias(n) for i, n in names_by_position.items()],
    )


def null_flags(df):
    """Every column replaced by 1 where it is NULL, else 0."""
    return df.select(*[is_null(c).cast("int").alias(c) for c in df.columns])


def stringify_cells(df, columns=None):
    """Every column (or those named) as text, NULL as the empty string."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(*[cell(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def uniform_sample(df, n=10, seed=0):
    """``n`` rows chosen by chance, but the same ones whatever the partitions.

    Those with the smallest checksums of all their cells and the ``seed``; each task keeps
    ``n`` of its own, and no row is sorted. Equal rows are chosen together."""
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (
        F.col(f"`{c}`").cast("string") for c in df.columns
    )]
    name = free_name(df.columns, "_checksum")
    marked = df.withColumn(name, F.md5(F.concat(F.lit(f"{seed}|"), *cells)))
    return marked.orderBy(name).limit(n).drop(name)


def preview(df, n=5, order_by=None):
    """``n`` rows. Unordered it stops after a few partitions; ordered it is repeatable."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
