"""Counters and rates, each one aggregate over one scan."""

from pyspark.sql import functions as F

from visitlog.functions.predicates import all_of, is_null, not_null


def percent(part, total, digits=4):
    """``part`` in percent of ``total``, NULL for an empty total."""
    return F.round(F.try_divide(part, total) * 100, digits)


def counted(condition=None, weight=None):
    """Aggregate of rows, or of a row-count column ``weight``, where ``condition`` holds."""
    if weight is None:
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    rows = F.col(weight) if condition is None else F.when(condition, F.col(weight))
    return F.coalesce(F.sum(rows), F.lit(0))


def split_counts(df, predicate, total="raw_rows", kept="kept_rows", dropped="filtered_out"):
    """Rows in all, rows that pass ``predicate``, and the rest."""
    rows, passed = counted(), counted(predicate)
    return df.agg(rows.alias(total), passed.alias(kept), (rows - passed).alias(dropped))


def match_rate(
    df, predicate, total="total_rows", matched="matching_rows", rate="percent", weight=None
):
    """Rows in all, rows that pass ``predicate``, and their percentage.

    ``weight`` names a count column if ``df`` holds groups instead of rows.
    """
    rows, hits = counted(weight=weight), counted(predicate, weight)
    return df.agg(rows.alias(total), hits.alias(matched), percent(hits, rows).alias(rate))


def _null_rows(columns):
    complete, total = F.count_if(all_of(not_null, columns)), counted()
    return [
        total.alias("total_rows"),
        complete.alias("clean_rows"),
        (total - complete).alias("null_rows"),
        percent(total - complete, total).alias("percent_null"),
    ]


def _nulls_per_column(columns):
    return [F.count_if(is_null(c)).alias(c) for c in columns]


def null_row_counts(df, columns=None):
    """Rows in all, rows without any NULL, rows with one, and their percentage."""
    return df.agg(*_null_rows(columns or df.columns))


def null_counts(df, columns=None):
    """One row with the number of NULLs of every column; zeros for no rows."""
    return df.agg(*_nulls_per_column(columns or df.columns))


def null_profile(df, columns=None):
    """:func:`null_row_counts` and :func:`null_counts` in one row from one scan."""
    columns = columns or df.columns
    return df.agg(*_null_rows(columns), *_nulls_per_column(columns))


def group_counts(df, keys, name="count"):
    """Rows per group. Map-side counting leaves one row per task of a hot group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_shares(df, keys, name="count", rate="percent"):
    """Rows per group and their percentage of all rows.

    The total is a scalar subquery over the same grouping, whose shuffle Spark
    reuses: one scan, and no window that pulls all groups into one task.
    """
    grouped = group_counts(df, keys, name)
    total = grouped.select(F.sum(name)).scalar()
    return grouped.withColumn(rate, percent(F.col(name), total))
