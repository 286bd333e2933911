"""Landing raw data once."""

from visitlog.session import file_system
from visitlog.sinks.csvfiles import export_csv
from visitlog.sources.delimited import read_positional_csv


def has_landed(spark, path):
    """Whether ``path`` holds a file, or a folder whose write was finished.

    A folder that is empty, or that still has a job's temporary folder and no
    success marker, is what an interrupted write leaves behind.
    """
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return False
    if fs.getFileStatus(root).isFile():
        return True
    inside = file_system(spark, f"{path}/_SUCCESS")[1], file_system(spark, f"{path}/_temporary")[1]
    if fs.exists(inside[0]):
        return True
    if fs.exists(inside[1]):
        return False
    # Up to the first data file only: a folder may hold very many.
    names = fs.listStatusIterator(root)
    while names.hasNext():
        if names.next().getPath().getName()[0] not in "_.":
            return True
    return False


def land_if_absent(df, path, fmt="text"):
    """Write ``df`` to ``path`` unless data landed there before.

    Returns True if this call wrote. An interrupted earlier write is replaced.
    With ``spark.read.text(source)`` as ``df`` the lines of a raw file land
    unchanged but for their line ends, which become newlines; a file is cut at
    any of them, so use :func:`land_csv_if_absent` where cells hold line breaks.
    """
    if has_landed(df.sparkSession, path):
        return False
    df.write.mode("overwrite").format(fmt).save(path)
    return True


def csv_width(spark, source):
    """Cells in the first record of a headerless file."""
    reader = spark.read.option("header", False).option("escape", '"').option("multiLine", True)
    return len(reader.csv(source).columns)


def land_csv_if_absent(spark, source, path, width=None, line_sep="\n"):
    """Land the records of quoted CSV files, each whole in one part file.

    Cells keep their text, line breaks of any kind included, if records end with
    ``line_sep``. With None they may end with any line break, and all line breaks
    within cells become newlines. Quotes are written where they are needed, an empty cell as nothing, and every record with
    ``width`` cells (by default as many as the first record has).
    """
    if has_landed(spark, path):
        return False
    width = width or csv_width(spark, source)
    export_csv(read_positional_csv(spark, source, width, rfc4180=True, line_sep=line_sep), path, header=False)
    return True
