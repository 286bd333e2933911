"""The most frequent of nearly unique values, without shuffling all of them.

Grouping counts a value in each task before the shuffle, which helps little if most values
occur once: nearly every row is then a group of its own. Here a first pass keeps a mergeable
sketch of frequent items, one of bounded size per task. A second pass counts the values the
sketch names, exactly, so only those are shuffled. A value that it does not name occurs in at
most a known share of the rows; if the ``k``-th count is above that, the answer is exact. Only
if it is not are all values grouped.
"""

from pyspark.sql import functions as F

from visitlog.operators.counting import group_counts
from visitlog.operators.names import free_name
from visitlog.operators.ranking import most_frequent
from visitlog.session import stage

# Values a sketch can name.
TRACKED = 10_000
# Fixed value: a sketch's estimates are off by at most 3.5 rows in as many as it tracks, and
# it leaves out what may be as frequent as twice that.
LEFT_OUT = 2 * 3.5


def frequent_values(df, column, k=10, tracked=TRACKED, name="count", staged=None):
    """The ``k`` most frequent values of a column, ties by value, as
    :func:`visitlog.operators.ranking.top_k_values` gives them; NULL is a value.

    ``df`` is read twice, or three times where frequent values cannot be told from others.
    Small stored tables are added to ``staged``, for :func:`visitlog.session.release`."""
    values = df.select(column)
    named = values.groupBy().agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{column}`, {tracked}, {tracked})").alias("found")
    )
    named = stage(named, "sketch", staged)
    hashed = free_name([column], "_hash")
    # At most ``tracked`` longs; a value with the hash of another is counted for nothing.
    wanted = named.select(F.explode("found.item").alias("item")).select(F.xxhash64("item").alias(hashed)).distinct()
    some = values.withColumn(hashed, F.xxhash64(column)).join(F.broadcast(wanted), hashed, "left_semi").drop(hashed)
    counts = stage(group_counts(some, [column], name), "counts", staged)
    top = most_frequent(counts, column, k, name)
    rows = named.first()["rows"]
    least = top.agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("least")).first()
    if least["n"] < k or least["least"] * tracked <= LEFT_OUT * rows:
        return most_frequent(group_counts(values, [column], name), column, k, name)
    return top
