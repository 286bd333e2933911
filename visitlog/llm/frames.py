"""Small helpers for frames whose other columns are unknown."""

# Joins name their method, so that a plan does not change with the input's size.
MERGE, HASH = "merge", "shuffle_hash"


def free_name(df, wanted):
    """``wanted``, or the first variation of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(df, most=4 << 20):
    """Have Spark hand rows to Python in batches of at most ``most`` bytes, or one row.

    The session's default is 64 MB: with long texts, copies of a batch on both sides
    would outgrow small executors. A smaller setting of the session is left alone."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(name).rstrip("b")) > most:
        conf.set(name, str(most))
