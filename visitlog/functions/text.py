"""Text expressions."""

from pyspark.sql import functions as F


def joined(*columns, sep=" "):
    """Columns joined by ``sep``; NULL if any of them is NULL."""
    parts = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(c).cast("string") if isinstance(c, str) else c)
    return F.concat(*parts)


def cell(c):
    """A column as export text: NULL becomes the empty string."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))
