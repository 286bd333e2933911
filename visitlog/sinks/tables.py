"""Catalog tables."""

from pyspark.sql import functions as F

from visitlog.operators.digest import digest_columns


def save_refined(df, table, fmt="orc", compact=False, path=None):
    """Replace ``table`` with the rows of ``df``.

    A selective filter over many input splits writes many small files.
    ``compact`` lets adaptive execution merge them (and split large ones) in one
    extra shuffle of the kept rows. ``path`` makes the table external.
    """
    if compact:
        df = df.hint("rebalance")
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def verify_written(spark, table, expected_rows, schema, digest=None):
    """One row: rows found, rows expected, and whether count and columns agree.

    Columns are compared by name and type, as a table does not keep nullability. With the
    ``digest`` that :func:`visitlog.operators.digest.digest_columns` gave while the rows
    were written, ``content_matches`` says whether the table still holds the same cells;
    that reads all of it, while a count alone needs the files' footers only.
    """
    stored = spark.read.table(table)
    same = [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
    names = [f.name for f in schema]
    content = [] if digest is None else [(digest_columns(names)[1] == digest).alias("content_matches")]
    if digest is not None and not same:
        content = [F.lit(False).alias("content_matches")]
    return stored.agg(
        F.count(F.lit(1)).alias("written_rows"),
        F.lit(expected_rows).cast("long").alias("expected_rows"),
        (F.count(F.lit(1)) == expected_rows).alias("rows_match"),
        F.lit(same).alias("schema_matches"),
        *content,
    )
