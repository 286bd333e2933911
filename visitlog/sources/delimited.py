"""Headerless delimited files."""

from visitlog.schema import RAW_WIDTH, positional_schema
from visitlog.sources.quoted import read_quoted_csv


def read_positional_csv(spark, path, width=RAW_WIDTH, sep=",", rfc4180=False, line_sep=None):
    """All-string frame ``_c0 .. _c{width-1}`` of a headerless file.

    Longer rows are cut at ``width``, shorter ones padded with NULL, and both
    quoted and unquoted empty fields are NULL. ``rfc4180`` reads doubled quotes
    and quoted line breaks (see :func:`visitlog.sources.quoted.read_quoted_csv`); that
    shuffles the lines once, so it is opt-in. Records end at any line break unless
    ``line_sep`` names it; only then do other line breaks within cells come back as
    they are.
    """
    if rfc4180:
        return read_quoted_csv(spark, path, width, sep, line_sep)
    reader = spark.read.schema(positional_schema(width)).option("header", False).option("sep", sep)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.csv(path)


def read_exported_csv(spark, path, schema, multi_line=False):
    """Read files written by :func:`visitlog.sinks.csvfiles.export_csv`.

    ``multi_line`` is needed if cells hold line breaks; each file is then read
    by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("lineSep", "\n")
        .csv(path)
    )
