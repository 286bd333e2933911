"""First, last, most and least frequent.

Each ends in sort + limit, which Spark runs as a top-k per partition and one
merge of k rows per partition. Ties are broken by named columns so that a
result is repeatable.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlog.operators.counting import group_counts
from visitlog.operators.names import free_name


def _ordered_by_key(df, key, order, tie_break, k, null_keys):
    name = free_name(df.columns, "_key")
    # The key is a column of its own so that it is computed once per row, not
    # once per comparison.
    ties = [F.col(c).asc_nulls_first() for c in tie_break or df.columns]
    top = (
        df.withColumn(name, F.col(key) if isinstance(key, str) else key)
        .orderBy(order(F.col(name)), *ties)
        .limit(k)
    )
    # Above the limit this drops what sorted last, without a second
    # computation of the key for every row.
    return (top if null_keys else top.filter(F.col(name).isNotNull())).select(*df.columns)


def earliest(df, key, k=1, tie_break=None, null_keys=True):
    """Rows with the ``k`` smallest keys.

    A NULL key counts as smallest; ``null_keys=False`` leaves such rows out.
    """
    order = Column.asc_nulls_first if null_keys else Column.asc_nulls_last
    return _ordered_by_key(df, key, order, tie_break, k, null_keys)


def latest(df, key, k=1, tie_break=None, null_keys=True):
    """Rows with the ``k`` largest keys; NULL as for :func:`earliest`."""
    return _ordered_by_key(df, key, Column.desc_nulls_last, tie_break, k, null_keys)


def earliest_and_latest(df, key):
    """Both ends by a numeric key in one scan, ties to the smaller row.

    One row with structs ``earliest`` and ``latest``, each NULL if there are no
    rows. A NULL key counts as smallest.
    """
    name, none = free_name(df.columns, "_key"), free_name(df.columns, "_none")
    rows = df.withColumn(name, key)
    up = F.struct(name, *df.columns)
    down = F.struct(F.col(name).isNull().alias(none), (-F.col(name)).alias(name), *df.columns)

    def first(order):
        smallest = F.min(order)
        return F.when(smallest.isNotNull(), F.struct(*[smallest[c].alias(c) for c in df.columns]))

    return rows.agg(first(up).alias("earliest"), first(down).alias("latest"))


def most_frequent(counts, column, k=10, name="count"):
    """The ``k`` largest of counted groups, ties by value."""
    return counts.orderBy(F.col(name).desc(), F.col(column).asc_nulls_first()).limit(k)


def least_frequent(counts, column, k=10, name="count"):
    """The ``k`` smallest of counted groups, ties by value."""
    return counts.orderBy(F.col(name).asc(), F.col(column).asc_nulls_first()).limit(k)


def top_k_values(df, column, k=10, name="count"):
    """The ``k`` most frequent values of a column, ties by value."""
    return most_frequent(group_counts(df, [column], name), column, k, name)


def bottom_k_values(df, column, k=10, name="count"):
    """The ``k`` least frequent values of a column, ties by value."""
    return least_frequent(group_counts(df, [column], name), column, k, name)


def first_distinct_values(df, column, k=30):
    """The first ``k`` distinct values of a column in sort order."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first()).limit(k)
