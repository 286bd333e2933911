"""Quoted CSV files, each read by as many tasks as it has splits.

A quoted cell may hold line breaks, so where a record begins depends on all that
comes before it. But a line can be begun in two states only, at the start of a record
or inside a quoted cell, and what a line, and so a split, makes of each state follows
from its own text. The table of splits is small; running over it gives the state in
which each split begins and how many records begin before it. With these the lines of
a split are put together to records within the split. Only the pieces of records that
cross a border between splits, two for a split at most, meet their other pieces.

The lines are shuffled once, by split, so a task sorts as much as one split holds. No
text reaches the driver or a Python worker.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlog.schema import positional_name
from visitlog.session import stage

# Places of the state within a line: at the start of a cell, in a cell without quotes
# around it, in a quoted one, and after a quote in a quoted one.
_START, _PLAIN, _QUOTED, _CLOSED = range(4)
_SPLIT = ["file", "block"]


def _ends_open(segments, opened, sep):
    """Whether a line ends inside a quoted cell, if it begins inside one or not.

    ``segments`` are the stretches of its text between quotes. A quote opens a cell only
    as its first sign, and two in a row stand for one."""

    def after(state, text):
        plain = F.when(F.endswith(text, F.lit(sep)), F.lit(_START)).otherwise(_PLAIN)
        return F.when((text == "") | (state == _QUOTED), state).otherwise(plain)

    def after_quote(state, text):
        quoted = (state == _START) | (state == _CLOSED)
        here = F.when(state == _QUOTED, F.lit(_CLOSED)).when(quoted, _QUOTED).otherwise(state)
        return after(here, text)

    first = F.element_at(segments, 1)
    begin = F.lit(_QUOTED) if opened else after(F.lit(_START), first)
    return F.aggregate(F.slice(segments, 2, F.size(segments)), begin, after_quote) == _QUOTED


def _lines(spark, path, line_sep, sep):
    """``file, block`` (the split's first byte), ``line`` (its place), ``value``, and
    what the line makes of both states."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    segments = F.split("value", '"')
    quotes = F.contains("value", F.lit('"'))
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        F.when(quotes, _ends_open(segments, False, sep)).otherwise(False).alias("open0"),
        F.when(quotes, _ends_open(segments, True, sep)).otherwise(True).alias("open1"),
    )


def _state_before(start, window):
    """The state before each row of a window, from that before its first row; rows with
    equal ``open0`` and ``open1`` set it, rows that swap them turn it round."""
    turned = F.sum(F.when(F.col("open0") & ~F.col("open1"), 1).otherwise(0)).over(
        window.rowsBetween(Window.unboundedPreceding, -1)
    )
    turned = F.coalesce(turned, F.lit(0))
    # Of rows that set the state, with the turns up to each.
    own = F.when(F.col("open0") == F.col("open1"), F.struct(F.col("open0").alias("to"), F.col("_turned").alias("at")))
    last = F.last(own, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def add(df):
        df = df.withColumn("_turned", turned).withColumn("_set", last)
        odd = (F.col("_turned") - F.coalesce("_set.at", F.lit(0))) % 2 == 1
        return df.withColumn("before", F.coalesce("_set.to", start) != odd).drop("_turned", "_set")

    return add


def _splits(lines):
    """One row per split: the state it begins with, whether it ends inside a cell, and
    the records that begin in it and before it in its file."""
    # Lines that do not keep the state, in order; the others lie between them.
    turning = F.when(F.col("open0") | ~F.col("open1"), F.struct("line", "open0", "open1"))
    found = lines.groupBy(*_SPLIT).agg(
        F.min("line").alias("first"), F.max("line").alias("last"), F.array_sort(F.collect_list(turning)).alias("turning")
    )

    def end(opened):
        """State after the last line, and records that begin, if the split begins so."""
        begin = F.struct(F.lit(opened).alias("open"), F.col("first").alias("next"), F.lit(0).cast("long").alias("n"))

        def step(state, x):
            records = F.when(state["open"], 0).otherwise(x["line"] + 1 - state["next"])
            opened = F.when(state["open"], x["open1"]).otherwise(x["open0"])
            return F.struct(opened.alias("open"), (x["line"] + 1).alias("next"), (state["n"] + records).alias("n"))

        def finish(state):
            rest = F.when(state["open"], 0).otherwise(F.col("last") + 1 - state["next"])
            return F.struct(state["open"].alias("open"), (state["n"] + rest).alias("n"))

        return F.aggregate("turning", begin, step, finish)

    ends = found.select(*_SPLIT, end(False).alias("e0"), end(True).alias("e1"))
    ends = ends.withColumns({"open0": F.col("e0.open"), "open1": F.col("e1.open")})
    in_file = Window.partitionBy("file").orderBy("block")
    known = _state_before(F.lit(False), in_file)(ends)
    chosen = F.when(F.col("before"), F.col("e1")).otherwise(F.col("e0"))
    counted = known.select(*_SPLIT, F.col("before").alias("begins"), chosen["open"].alias("ends"), chosen["n"].alias("records"))
    earlier = F.sum("records").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("earlier", F.coalesce(earlier, F.lit(0)))


def _joined(order):
    """The values of a group in order, as lines."""
    values = F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda x: x["value"])
    return F.array_join(values, "\n")


def read_quoted_records(spark, path, line_sep="\n", sep=",", staged=None):
    """One string per record of the files under ``path``; empty lines between records
    are none. Without ``line_sep`` lines end at any line break, and those inside cells
    become newlines. The small table of splits is stored; ``staged`` is for
    :func:`visitlog.session.release`."""
    lines = _lines(spark, path, line_sep, sep)
    splits = stage(_splits(lines), "splits", staged)
    in_split = Window.partitionBy(*_SPLIT).orderBy("line")
    known = _state_before(F.col("begins"), in_split)(lines.join(splits.hint("shuffle_hash"), _SPLIT))
    numbered = known.withColumn("record", F.sum(F.when(F.col("before"), 0).otherwise(1)).over(in_split))
    pieces = numbered.groupBy(*_SPLIT, "record", "ends", "records", "earlier").agg(_joined("line").alias("value"))
    # Of a split, what comes before its first record, and its last one if that goes on.
    crosses = (F.col("record") == 0) | (F.col("ends") & (F.col("record") == F.col("records")))
    crossing = (
        pieces.filter(crosses)
        .groupBy("file", (F.col("earlier") + F.col("record")).alias("record"))
        .agg(_joined("block").alias("value"))
    )
    return pieces.filter(~crosses).select("value").unionAll(crossing.select("value")).filter("value != ''")


def read_quoted_csv(spark, path, width, sep=",", line_sep="\n", staged=None):
    """All-string frame ``_c0 .. _c{width-1}`` of quoted files without a header, equal
    to Spark's reader with ``multiLine`` but for the order of rows. A quote that is never
    closed makes one record of the rest of its file, as it does there; only the file's last
    line break is no part of it here."""
    options = {"sep": sep, "escape": '"', "lineSep": "\n", "maxCharsPerColumn": "-1"}
    cells = F.from_csv("value", ", ".join(f"{positional_name(i)} string" for i in range(width)), options)
    return read_quoted_records(spark, path, line_sep, sep, staged).select(cells.alias("cells")).select("cells.*")
