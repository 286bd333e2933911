"""The daily run over new files only.

``base`` holds a folder of rows for each batch of files, the partial sums of its charts,
and a manifest: one folder for each batch with a row for each file, its length, time of
change, rows and digest. Writing the manifest's folder is what makes a batch count: rows
of a batch without it are never read, and the next run writes them again. So a run that
fails anywhere can be repeated, and a run without new files writes nothing.

A file is known by its path, length and time of change, and is not opened again. One
whose length or time differs from the manifest's is read: if its rows are the same it is
noted as seen, else the run stops before it writes anything, as rows of the former file
are stored already. One run at a time may write to a ``base``.
"""

import hashlib

from pyspark.sql import functions as F

from visitlog.functions.predicates import not_empty
from visitlog.operators.counting import group_counts, percent
from visitlog.operators.digest import content_digest
from visitlog.operators.ranking import most_frequent
from visitlog.plans import analyses, dashboards, quality
from visitlog.plans.refine import refine
from visitlog.schema import REFINED_COLUMNS, VISITEE, refined_schema
from visitlog.session import file_system, stage
from visitlog.sinks.versions import write_checked
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.files import escaped, list_files

MANIFEST = (
    "batch string, path string, uri string, length long, modified timestamp, rows long, digest string,"
    " batch_rows long, batch_digest string"
)
# Columns of each kind of partial sums that are added up; the others are its keys.
PARTIALS = {
    "hours": ["count", "gap_sum", "gap_rows"],
    "gaps": ["count"],
    "locations": ["count"],
    "comments": ["count"],
    "visitors": ["count"],
}


class ChangedFile(Exception):
    """A file whose rows are stored has other rows now."""


def _finished(spark, base):
    """Folders of the manifest whose write was finished."""
    fs, root = file_system(spark, f"{base}/manifest")
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return [n for n in names if fs.exists(file_system(spark, f"{base}/manifest/{n}/_SUCCESS")[1])]


def read_manifest(spark, base):
    """The files of all batches that count."""
    base = base.rstrip("/")
    paths = [f"{base}/manifest/{name}" for name in _finished(spark, base)]
    return spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)


def read_batches(spark, base, fmt="orc"):
    """The refined rows of all batches that count."""
    base = base.rstrip("/")
    paths = [f"{base}/rows/{name}" for name in _finished(spark, base) if not name.startswith("seen-")]
    if not paths:
        return spark.createDataFrame([], refined_schema())
    return spark.read.format(fmt).schema(refined_schema()).load(paths).select(*REFINED_COLUMNS)


def _raw(spark, files, rfc4180):
    """The rows of some files, by path."""
    return read_positional_csv(spark, [escaped(f.path) for f in files], rfc4180=rfc4180)


def _digests(spark, files):
    """Lines and digest of each file, whatever their order."""
    lines = spark.read.text([escaped(f.path) for f in files]).select("value", F.col("_metadata.file_path").alias("uri"))
    return content_digest(lines, ["uri"])


def _write_manifest(spark, base, batch, files, digests, rows=0, digest=""):
    listed = spark.createDataFrame(
        [(batch, f.path, f.uri, f.length, f.modified) for f in files],
        "batch string, path string, uri string, length long, modified timestamp",
    )
    # Files without lines have no digest.
    noted = listed.join(digests, "uri", "left").select(
        "batch", "path", "uri", "length", "modified", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("digest", F.lit("")).alias("digest"), F.lit(rows).cast("long").alias("batch_rows"),
        F.lit(digest).alias("batch_digest"),
    )
    noted.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/{batch}")


def _changed(spark, files, known):
    """Of files that the manifest knows with another length or time, those that were only
    touched; raises if one has other rows."""
    before = known.select("uri", "rows", "digest").dropDuplicates(["uri"])
    again = files.join(before, "uri").collect()
    if not again:
        return []
    now = {r.uri: (r.rows, r.digest) for r in _digests(spark, again).collect()}
    other = [f.path for f in again if now.get(f.uri, (0, "")) != (f["rows"], f.digest)]
    if other:
        raise ChangedFile(f"{len(other)} files were stored with other rows, the first is {other[0]}")
    return again


def refine_new_files(spark, log, base, visitee=VISITEE, fmt="orc", clock="12h", rfc4180=False):
    """Refine the files below ``log`` that no earlier run has stored under ``base``.

    One row: new files, rows stored by this run, files and rows stored altogether."""
    base = base.rstrip("/")
    known = stage(read_manifest(spark, base), "manifest")
    same = ["uri", "length", "modified"]
    arrived = stage(list_files(spark, log).join(known.select(*same), same, "left_anti"), "arrived")
    touched = sorted(_changed(spark, arrived, known))
    if touched:
        _write_manifest(spark, base, f"seen-{_batch(touched)}", touched, _digests(spark, touched))
    # Names of new files only reach the driver, which needs them to plan their reading.
    seen = {f.uri for f in touched}
    new = [f for f in sorted(arrived.collect()) if f.uri not in seen]
    if new:
        batch = _batch(new)
        path = f"{base}/rows/{batch}"
        stored, digest = write_checked(refine(_raw(spark, new, rfc4180), visitee), path, fmt)
        rows = spark.read.format(fmt).schema(refined_schema()).load(path)
        for name, partial in partial_sums(rows, clock).items():
            partial.write.mode("overwrite").parquet(f"{base}/partials-{clock}/{name}/{batch}")
        _write_manifest(spark, base, batch, new, _digests(spark, new), stored, digest)
    batches = read_manifest(spark, base).groupBy("batch").agg(
        F.countDistinct("uri").alias("files"), F.first("batch_rows").alias("rows")
    )
    mine = F.col("batch") == (_batch(new) if new else "")
    return batches.agg(
        F.coalesce(F.sum(F.when(mine, F.col("files"))), F.lit(0)).alias("new_files"),
        F.coalesce(F.sum(F.when(mine, F.col("rows"))), F.lit(0)).alias("new_rows"),
        F.coalesce(F.sum(F.when(~F.col("batch").startswith("seen-"), F.col("files"))), F.lit(0)).alias("all_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"),
    )


def _batch(files):
    """The name of a batch follows from its files, so a repeated run writes the same folder."""
    text = "\n".join(f"{f.uri}|{f.length}|{f.modified.isoformat()}" for f in files)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def partial_sums(visits, clock="12h"):
    """Counts of one batch, of which those of several batches are the sums. Each is a
    grouping with a map-side count, so a hot value is one row per task."""
    cleaned = quality.clean(visits)
    return {
        "hours": dashboards.time_counts(cleaned, clock=clock),
        "gaps": dashboards.arrival_gap_hist(cleaned, clock),
        "locations": group_counts(cleaned, ["meeting_location"]),
        "comments": group_counts(cleaned.filter(not_empty("info_comment")), ["info_comment"]),
        "visitors": group_counts(analyses.full_names(cleaned), ["visitor_full_name"]),
    }


def merged(spark, base, name, clock="12h", keys=None):
    """The sums of one kind over all batches that count, per ``keys`` (by default all)."""
    base = base.rstrip("/")
    batches = [n for n in _finished(spark, base) if not n.startswith("seen-")]
    empty = partial_sums(spark.createDataFrame([], refined_schema()), clock)[name]
    paths = [f"{base}/partials-{clock}/{name}/{n}" for n in batches]
    parts = spark.read.schema(empty.schema).parquet(*paths) if paths else empty
    sums = PARTIALS[name]
    keys = keys or [c for c in parts.columns if c not in sums]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def merged_charts(spark, base, clock="12h"):
    """The charts over all batches, from their partial sums; no visit is read."""
    year, month, hour = dashboards.EXPORT_PARTS
    months = merged(spark, base, "hours", clock, [year, month])
    locations = merged(spark, base, "locations", clock)
    return {
        "monthly_visits": months.select(year, month, "count"),
        "hour_month_heat": merged(spark, base, "hours", clock, [hour, month]).select(hour, month, "count"),
        "visit_kpis": dashboards.kpis_of(months),
        "location_share": locations.withColumn("percent", percent(F.col("count"), locations.select(F.sum("count")).scalar())),
        "arrival_gap_hist": merged(spark, base, "gaps", clock),
        "top_comments": most_frequent(merged(spark, base, "comments", clock), "info_comment"),
        "top_visitors": most_frequent(merged(spark, base, "visitors", clock), "visitor_full_name", 20),
    }
