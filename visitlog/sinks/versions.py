"""Tables that are replaced without a gap."""

import uuid

from pyspark.sql import Observation

from visitlog.operators.digest import content_digest, digest_columns
from visitlog.session import file_system

VERSION = "version-"


class NotWritten(Exception):
    """What is stored is not what was to be written."""


def write_checked(df, path, fmt="orc"):
    """Write ``df`` to the new folder ``path`` and read it back, whole.

    Rows are counted and hashed in the tasks that write them, and again from the folder;
    returns ``(rows, digest)`` or raises :class:`NotWritten`. A frame whose rows change
    from run to run does not matter: what is compared is what was written."""
    seen = Observation()
    kept = df.observe(seen, *digest_columns(df.columns))
    kept.write.mode("overwrite").format(fmt).save(path)
    written = seen.get["rows"], seen.get["digest"]
    stored = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
    found = tuple(content_digest(stored).first())
    if found != written:
        raise NotWritten(f"{path} holds {found}, not {written}")
    return written


def _location(spark, table):
    """Where a table's files are, None for one that is not there."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def replace_table(df, table, base, fmt="orc"):
    """Replace ``table`` with the rows of ``df``; returns ``(rows, digest)``.

    The rows go to a new folder under ``base`` and are checked there; only then the
    table is pointed to it, by one change in the catalog, and its former version under
    ``base`` is deleted. Until then, and if anything fails on the way, the table is what
    it was, so ``df`` may read the table itself. A table with other columns is dropped
    and made anew over the checked folder, files of other places stay."""
    spark = df.sparkSession
    base = base.rstrip("/")
    path = f"{base}/{VERSION}{uuid.uuid4().hex}"
    try:
        result = write_checked(df, path, fmt)
    except BaseException:
        _delete(spark, path)
        raise
    former = _location(spark, table)
    if former is not None and _same_columns(spark, table, df, fmt):
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, fmt, df.schema)
    spark.catalog.refreshTable(table)
    if former and _name(former).startswith(VERSION) and _parent(former) == _parent(str(file_system(spark, path)[1])):
        _delete(spark, former)
    return result


def _same_columns(spark, table, df, fmt):
    stored = spark.read.table(table).schema
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").first()
    same = [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in df.schema]
    return same and provider and provider["data_type"].lower() == fmt


def _name(path):
    return path.rstrip("/").rsplit("/", 1)[-1]


def _parent(path):
    """The folder a path is in, without a scheme's empty authority."""
    parent = path.rstrip("/").rsplit("/", 1)[0]
    return parent.replace("file:///", "/").removeprefix("file:")


def _delete(spark, path):
    fs, target = file_system(spark, path)
    fs.delete(target, True)
