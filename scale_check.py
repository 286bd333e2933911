"""Run the whole flow on many copies of the events table with a hot third.

One row in three is the same visitor, time, place and purpose. Prints one JSON
line per step with its seconds; the numbering step adds how evenly its sort
spread the rows.

    SCALE_COPIES=200 SCALE_CPUS=8 python scale_check.py <new empty folder>
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from visitlog.operators.counting import null_counts, null_row_counts
from visitlog.operators.paging import PLACE_BITS, number_rows
from visitlog.plans import analyses, dashboards, export, quality
from visitlog.plans.refine import refine_to_table
from visitlog.schema import REFINED_COLUMNS
from visitlog.plans.report import analysis_results, shared_analysis_results
from visitlog.sinks.csvfiles import export_csv
from visitlog.sinks.publish import publish_all
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.derived import as_positional, visits_from_events
from visitlog.sources.tables import read_refined

SF_DIR = os.environ.get("SCALE_SF_DIR", "/root/testdata/sf0.1")
COPIES = int(os.environ.get("SCALE_COPIES", "200"))
CPUS = os.environ.get("SCALE_CPUS", "8")
HOT = {
    "lname": "Hot",
    "fname": "Very",
    "time_of_arrival": "01/15/2024 09:30",
    "appt_scheduled_time": "01/15/2024 10:00",
    "meeting_location": "WH",
    "info_comment": "GENERAL RECEPTION",
    "visitee": "POTUS",
}


def hot_log(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(int(CPUS) * 4)
    copies = events.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    ).withColumn("event_id", F.col("event_id") * COPIES + F.col("copy"))
    log = visits_from_events(copies)
    hot = F.col("event_id") % 3 == 0
    return log.select(*[
        F.when(hot, F.lit(HOT[c])).otherwise(F.col(c)).alias(c) if c in HOT else F.col(c)
        for c in log.columns
    ])


def timed(step, action, **extra):
    start = time.perf_counter()
    result = action()
    seconds = round(time.perf_counter() - start, 2)
    print(json.dumps({"step": step, "seconds": seconds, **(result or {}), **extra}), flush=True)


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def publish(results, folder):
    publish_all(results, f"{folder}/published")


def main(folder):
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("visitlog-scale")
        .config("spark.sql.shuffle.partitions", str(int(CPUS) * 3))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.local.dir", f"{folder}/local")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw_path = f"{folder}/raw"
    timed("make raw log", lambda: export_csv(as_positional(hot_log(spark)), raw_path, header=False))
    raw = read_positional_csv(spark, raw_path)
    timed("refine to table", lambda: refine_to_table(raw, "refined").first().asDict())
    timed("refine, compacted", lambda: refine_to_table(raw, "compacted", compact=True).first().asDict())

    visits = read_refined(spark, "refined")
    steps = {
        "first visitor": analyses.first_visitor(visits),
        "last visitor": analyses.last_visitor(visits),
        "top comments": analyses.top_comments(visits),
        "least comments": analyses.least_comments(visits),
        "variation rate": analyses.variation_rate(visits),
        "variation values": analyses.variation_values(visits),
        "top visitors": analyses.top_visitors(visits),
        "null rows": null_row_counts(visits),
        "null counts": null_counts(visits),
        "missing purpose": quality.missing_purpose_rate(visits),
        "profile in one scan": quality.visit_profile(visits, REFINED_COLUMNS),
        "location share": dashboards.location_share(visits),
        "gap histogram": dashboards.arrival_gap_hist(visits),
        "kpis": dashboards.visit_kpis(quality.clean(visits)),
        "export rows": export.visits_export(visits),
    }
    for step, df in steps.items():
        timed(step, lambda df=df: drain(df))
    timed("all results, each alone", lambda: publish(analysis_results(visits), folder))

    def shared():
        with shared_analysis_results(visits) as results:
            publish(results, folder)

    timed("all results, shared", shared)
    timed("export csv", lambda: export_csv(export.export_cells(visits), f"{folder}/export"))
    timed("pages, stored order", lambda: drain(export.export_batches(visits)))

    # Merging by bytes would hide how the sort itself spread the rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def number():
        numbered = number_rows(visits, list(REFINED_COLUMNS))
        stats = numbered.agg(F.count(F.lit(1)).alias("n"), F.max("row_number").alias("last")).first()
        assert stats.n == stats.last
        placed = next(f for f in numbered.inputFiles() if "visitlog-placed-" in f).rsplit("/", 1)[0]
        sizes = spark.read.parquet(placed).groupBy(F.shiftrightunsigned("_place", PLACE_BITS)).count()
        spread = sizes.agg(F.max("count").alias("most"), F.avg("count").alias("mean")).first()
        return {"rows": stats.n, "largest_over_mean": round(spread.most / spread.mean, 3)}

    timed("numbers, sorted, a third tied", number)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
