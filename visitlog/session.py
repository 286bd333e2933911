"""Session factory and the shared folder for intermediate tables."""

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# How the names of this package's folders begin.
STAGED = "visitlog-"


def get_session(app_name="Visit Log", hive=True, log_level="ERROR"):
    """Get or create a session, by default with a Hive catalog.

    Master, memory and shuffle settings are left to ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


@cache
def _local_folder():
    return tempfile.mkdtemp(prefix=STAGED)


def _in_one_process(master):
    return master == "local" or master.startswith("local[")


@cache
def _seen_by_executors(spark, folder):
    """Whether tasks see a file that the driver puts into ``folder``."""
    fs, target = file_system(spark, f"{folder}/{STAGED}seen-{uuid.uuid4().hex}")
    local = target.toUri().getPath()

    def look(batches):
        seen = os.path.exists(local)
        for batch in batches:
            if not seen and batch.num_rows:
                yield batch

    fs.mkdirs(target)
    try:
        tasks = 4 * spark.sparkContext.defaultParallelism
        return spark.range(0, tasks, 1, tasks).mapInArrow(look, "id long").isEmpty()
    finally:
        fs.delete(target, True)


def shared_folder(spark):
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a master within one process may fall back to a temporary folder: on a
    cluster a machine-local folder is lost with its machine. A ``file:`` folder on
    a cluster is taken only if the executors see what the driver puts there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    if not folder:
        if not _in_one_process(master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        return _local_folder()
    folder = folder.rstrip("/")
    # A local-cluster has its executors on one machine.
    if not master.startswith("local"):
        fs, _ = file_system(spark, folder)
        if fs.getScheme() == "file" and not _seen_by_executors(spark, folder):
            raise ValueError(f"executors do not see {folder}: spark.checkpoint.dir must be shared by all")
    return folder


# What this process has made: a run's folder in each shared folder, and its tables.
_runs, _tables = {}, []


def new_shared_path(spark, label):
    """A path in this run's part of the shared folder that nothing has used yet."""
    folder = shared_folder(spark)
    if folder not in _runs:
        _runs[folder] = f"{folder}/{STAGED}run-{uuid.uuid4().hex}"
    return f"{_runs[folder]}/{label}-{uuid.uuid4().hex}"


def scratch_table(spark, label):
    """Name and location of an external table nothing has used yet; dropped by
    :func:`close_run`."""
    name = f"{label}_{uuid.uuid4().hex}"
    _tables.append(name)
    return name, new_shared_path(spark, "table")


def close_run(spark):
    """Drop the run's scratch tables and delete all it has put into the shared folder.

    Frames that read from there cannot be run afterwards."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    release(spark, list(_runs.values()))
    _runs.clear()


def file_system(spark, path):
    """Hadoop's file system and path objects for ``path``."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def stage(df, label="stage", staged=None):
    """Write ``df`` as parquet in the shared folder and read it back.

    This cuts the lineage: generated ids in the frame are now stored values, so
    the loss of an executor cannot change them between two passes. The folder is
    added to the list ``staged``, for :func:`release`; :func:`close_run` deletes
    it at the latest.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    if staged is not None:
        staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark, paths):
    """Delete staged folders by path; frames that read them cannot be run afterwards."""
    while paths:
        fs, target = file_system(spark, paths.pop())
        fs.delete(target, True)
