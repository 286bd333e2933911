"""Digests of rows that do not depend on their order, place or number of files."""

from pyspark.sql import functions as F

from visitlog.operators.names import free_name


def row_hash(columns):
    """64 bits of a row's cells; NULL differs from every text and from its neighbour's
    NULL, as which cells are NULL is hashed too."""
    return F.xxhash64(*[F.isnull(F.col(f"`{c}`")) for c in columns], *[F.col(f"`{c}`") for c in columns])


def digest_columns(columns, hashed=None):
    """Aggregates that tell a multiset of rows: ``rows`` and a text ``digest``.

    A sum and an exclusive or of two hashes of each row: a row more, a row less and a
    changed cell show in both, repeated rows count in the sum. Both can be merged, so a
    task gives one row, and they can be observed while the rows are written. ``hashed``
    names a column that holds :func:`row_hash`."""
    one = F.col(hashed) if hashed else row_hash(columns)
    total = F.coalesce(F.sum(one.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    folded = F.coalesce(F.bit_xor(F.xxhash64(one)), F.lit(0).cast("long"))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.concat(total.cast("string"), F.lit(":"), F.lower(F.hex(folded))).alias("digest"),
    ]


def content_digest(df, keys=(), columns=None):
    """``rows`` and ``digest`` of a frame, or of each group of it."""
    columns = columns or [c for c in df.columns if c not in keys]
    name = free_name(df.columns, "_hash")
    hashed = df.select(*keys, row_hash(columns).alias(name))
    return hashed.groupBy(*keys).agg(*digest_columns(columns, name))
