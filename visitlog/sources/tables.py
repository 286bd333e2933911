"""Catalog tables."""

from visitlog.schema import REFINED_COLUMNS


def read_refined(spark, table, columns=REFINED_COLUMNS):
    """The refined visits stored as ``table``, columns in their fixed order."""
    return spark.read.table(table).select(*columns)
