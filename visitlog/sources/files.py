"""Files as rows."""

import re

from pyspark.sql import functions as F


def list_files(spark, path):
    """One row per file below ``path``: ``path``, its ``uri`` (as Spark names it in
    ``_metadata``), ``length`` and ``modified``. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").cast("timestamp").alias("modified"),
    )


def escaped(path):
    """A path as a reader's pattern for just it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
