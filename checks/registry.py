"""Every query by name, as ``f(spark, sf_dir) -> DataFrame`` over whole tables."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from visitlog.functions.predicates import equals, is_empty, matches, not_empty
from visitlog.functions.text import joined
from visitlog.operators.counting import (
    group_counts,
    group_shares,
    match_rate,
    null_counts,
    null_row_counts,
    split_counts,
)
from visitlog.operators.digest import digest_columns
from visitlog.operators.frequent import frequent_values
from visitlog.operators.paging import assign_batches, number_rows
from visitlog.operators.ranking import (
    bottom_k_values,
    earliest,
    first_distinct_values,
    latest,
    top_k_values,
)
from visitlog.operators.reshape import null_flags, uniform_sample
from visitlog.plans import analyses, dashboards, export, quality
from visitlog.plans.incremental import merged_charts, read_batches, refine_new_files
from visitlog.plans.refine import refine, refine_counts, refine_log, refine_to_table
from visitlog.plans.report import shared_analysis_results, shared_chart_results
from visitlog.schema import REFINED_COLUMNS, SAMPLE_COLUMNS, export_schema
from visitlog.session import new_shared_path, scratch_table
from visitlog.sinks.csvfiles import export_csv
from visitlog.sinks.publish import publish_all
from visitlog.sinks.tables import save_refined, verify_written
from visitlog.sinks.versions import replace_table
from visitlog.sources.delimited import read_exported_csv, read_positional_csv
from visitlog.sources.derived import as_positional, visits_from_events
from visitlog.sources.landing import land_csv_if_absent, land_if_absent
from visitlog.sources.tables import read_refined

PART_PATTERN = "RED|RING"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visits(spark, sf_dir):
    return visits_from_events(table(spark, sf_dir, "events"))


def raw_log(spark, sf_dir):
    """The headerless layout, plus the unique ``event_id``."""
    return as_positional(visits(spark, sf_dir), keep=["event_id"])


def refined(spark, sf_dir):
    """Refined visits, plus the unique ``event_id`` for tie-breaks."""
    return refine(raw_log(spark, sf_dir), keep=["event_id"])


def refined_only(spark, sf_dir):
    return refine(raw_log(spark, sf_dir))


def written_log(spark, sf_dir):
    """The raw log as headerless CSV files, read back by position."""
    path = new_shared_path(spark, "log")
    export_csv(as_positional(visits(spark, sf_dir)), path, header=False)
    return read_positional_csv(spark, path)


# --- load, filter, store ---------------------------------------------------


def stored_refined(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    save_refined(refine_log(written_log(spark, sf_dir)), name, path=path)
    return read_refined(spark, name)


def stored_refined_compact(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    save_refined(refined_only(spark, sf_dir), name, compact=True, path=path)
    return read_refined(spark, name)


def refine_written_counts(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    return refine_to_table(written_log(spark, sf_dir), name, path=path)


def refine_compact_counts(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    return refine_to_table(written_log(spark, sf_dir), name, compact=True, path=path)


def written_check(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    rows, written = refined_only(spark, sf_dir), Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
    save_refined(counted, name, fmt="parquet", path=path)
    return verify_written(spark, name, written.get["n"], rows.schema)


def content_check(spark, sf_dir):
    name, path = scratch_table(spark, "visits_refined")
    rows, written = refined_only(spark, sf_dir), Observation()
    save_refined(rows.observe(written, *digest_columns(rows.columns)), name, path=path)
    return verify_written(spark, name, written.get["rows"], rows.schema, written.get["digest"])


def replaced_refined(spark, sf_dir):
    """The raw log's visitees, then the refined rows put in their place."""
    name, base = scratch_table(spark, "visits_refined")
    replace_table(visits(spark, sf_dir).select("visitee"), name, base)
    replace_table(refined_only(spark, sf_dir), name, base)
    replace_table(read_refined(spark, name), name, base)
    return read_refined(spark, name)


def two_days(spark, sf_dir):
    """The log as files of two days, refined after each: ``(base, counts)``."""
    log, base = new_shared_path(spark, "log"), new_shared_path(spark, "batches")
    for day in (0, 1):
        arrived = visits(spark, sf_dir).filter(F.col("event_id") % 2 == day)
        export_csv(as_positional(arrived), f"{log}/day-{day}", header=False)
        counts = refine_new_files(spark, log, base)
    return base, counts


def refine_two_batches(spark, sf_dir):
    return read_batches(spark, two_days(spark, sf_dir)[0])


def new_file_counts(spark, sf_dir):
    return two_days(spark, sf_dir)[1].select("new_rows", "all_rows")


def merged_chart(name):
    return lambda spark, sf_dir: merged_charts(spark, two_days(spark, sf_dir)[0])[name]


def landed_log(spark, sf_dir):
    """Land the log, then try to land half of it over the first."""
    path = new_shared_path(spark, "landed")
    log = visits(spark, sf_dir)
    land_if_absent(log, path, "parquet")
    land_if_absent(log.filter("event_id % 2 = 0"), path, "parquet")
    return spark.read.parquet(path)


def landed_documents(spark, sf_dir):
    """Land the documents, texts with line breaks, as the raw CSV file they could be."""
    documents = table(spark, sf_dir, "documents")
    source, landed = new_shared_path(spark, "raw"), new_shared_path(spark, "landed")
    export_csv(documents, source, header=False)
    land_csv_if_absent(spark, source, landed)
    rows = read_positional_csv(spark, landed, len(documents.columns), rfc4180=True, line_sep="\n")
    return rows.select(*[
        F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(rows.columns, documents.schema)
    ])


# --- export ----------------------------------------------------------------


def visits_export(clock="12h"):
    return lambda spark, sf_dir: export.visits_export(refined_only(spark, sf_dir), clock)


def export_cells(spark, sf_dir):
    return export.export_cells(refined_only(spark, sf_dir))


def export_batches(spark, sf_dir):
    return export.export_batches(refined(spark, sf_dir), order_by=["event_id"], unique=True)


def export_csv_roundtrip(spark, sf_dir):
    path = new_shared_path(spark, "export")
    export_csv(export_cells(spark, sf_dir), path)
    return read_exported_csv(spark, path, export_schema())


def documents_csv_roundtrip(spark, sf_dir):
    path = new_shared_path(spark, "documents")
    documents = table(spark, sf_dir, "documents")
    export_csv(documents, path)
    return read_exported_csv(spark, path, documents.schema, multi_line=True)


def comments_csv_roundtrip(spark, sf_dir):
    """One column alone: NULL, empty, blank and text cells."""
    path = new_shared_path(spark, "comments")
    comments = refined_only(spark, sf_dir).select("info_comment")
    export_csv(comments, path)
    return read_exported_csv(spark, path, comments.schema)


def published(results, name):
    """One of the shared results as the job publishes it, read back."""

    def query(spark, sf_dir):
        base = new_shared_path(spark, "published")
        with results(refined_only(spark, sf_dir)) as shared:
            paths = publish_all({name: shared[name]}, base)
        return spark.read.parquet(paths[name])

    return query


def published_outputs(spark, sf_dir):
    """Publish three analyses, then report each output's rows and counts."""
    rows = refined(spark, sf_dir)
    outputs = {
        "least_comments": analyses.least_comments(rows),
        "top_comments": analyses.top_comments(rows),
        "top_visitors": analyses.top_visitors(rows),
    }
    paths = publish_all(outputs, new_shared_path(spark, "published"))
    parts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("analysis"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum("count").alias("visit_count"),
        )
        for name, path in paths.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def on_refined(plan, *args, **kwargs):
    return lambda spark, sf_dir: plan(refined(spark, sf_dir), *args, **kwargs)


def on_refined_only(plan, *args, **kwargs):
    return lambda spark, sf_dir: plan(refined_only(spark, sf_dir), *args, **kwargs)


def on_export(plan, clock="12h", *args):
    return lambda spark, sf_dir: plan(
        export.visits_export(refined_only(spark, sf_dir), clock), *args
    )


def on_cleaned(plan, *args, **kwargs):
    return lambda spark, sf_dir: plan(
        quality.clean(refined_only(spark, sf_dir)), *args, **kwargs
    )


def visitor(plan, clock="12h", require_parsed=False):
    """First or last visitor, ties by ``event_id``, refined columns only."""
    return lambda spark, sf_dir: plan(
        refined(spark, sf_dir), clock, require_parsed, tie_break=["event_id"]
    ).select(*REFINED_COLUMNS)


# --- the same operators on other tables --------------------------------------


def on_table(name, build):
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


def top_customer_groups(customers):
    named = customers.select(joined("c_mktsegment", "c_nationkey").alias("segment_nation"))
    return top_k_values(named, "segment_nation", 20)


def monthly_orders(orders):
    parts = orders.select(
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month")
    )
    return dashboards.monthly_visits(parts, "order_year", "order_month")


def order_batches(orders):
    return assign_batches(
        orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], unique=True
    )


def shipment_numbers(lineitem):
    """Long runs of equal rows, numbered in sort order."""
    columns = ["l_returnflag", "l_linestatus", "l_shipdate"]
    return number_rows(lineitem.select(*columns), columns)


ANALYSES = (
    "first_visitor", "last_visitor", "top_comments", "least_comments", "variation_rate",
    "variation_values", "top_visitors", "null_rows", "null_counts", "missing_purpose_rate",
    "missing_purpose_sample",
)
CHARTS = (
    "monthly_visits", "hour_month_heat", "top_visitors", "location_share", "arrival_gap_hist",
    "top_comments", "visit_kpis",
)

MERGED = ("monthly_visits", "top_visitors", "arrival_gap_hist", "visit_kpis")

QUERIES = {
    # Load, filter, store.
    "visits_refined": refined_only,
    "refine_counts": lambda spark, sf_dir: refine_counts(raw_log(spark, sf_dir)),
    "stored_refined": stored_refined,
    "stored_refined_compact": stored_refined_compact,
    "refine_written_counts": refine_written_counts,
    "refine_compact_counts": refine_compact_counts,
    "written_check": written_check,
    "content_check": content_check,
    "replaced_refined": replaced_refined,
    "refine_two_batches": refine_two_batches,
    "new_file_counts": new_file_counts,
    **{f"merged_{n}": merged_chart(n) for n in MERGED},
    "landed_log": landed_log,
    "landed_documents": landed_documents,
    # The eight analyses.
    "first_visitor": visitor(analyses.first_visitor),
    "first_visitor_24h": visitor(analyses.first_visitor, "24h"),
    "first_visitor_parsed": visitor(analyses.first_visitor, require_parsed=True),
    "last_visitor": visitor(analyses.last_visitor),
    "last_visitor_24h": visitor(analyses.last_visitor, "24h"),
    "top_comments": on_refined(analyses.top_comments),
    "least_comments": on_refined(analyses.least_comments),
    "variation_rate": on_refined(analyses.variation_rate),
    "variation_values": on_refined(analyses.variation_values),
    "top_visitors": on_refined(analyses.top_visitors),
    "top_visitors_sketched": on_refined(lambda t: frequent_values(
        analyses.full_names(t), "visitor_full_name", 20
    )),
    "top_comments_sketched": on_refined(lambda t: frequent_values(
        t.filter(not_empty("info_comment")), "info_comment"
    )),
    "top_visitors_named": on_refined(analyses.top_visitors, keep_null=False),
    "null_row_profile": on_refined_only(null_row_counts),
    "null_counts": on_refined_only(null_counts),
    "null_flags": on_refined_only(null_flags),
    "missing_purpose_rate": on_refined(quality.missing_purpose_rate),
    "missing_purpose_sample": on_refined(quality.missing_purpose_sample, order_by=["event_id"]),
    "missing_purpose_uniform_sample": on_refined(
        lambda t: uniform_sample(t.filter(is_empty("info_comment")).select(*SAMPLE_COLUMNS, "event_id"))
    ),
    "visit_profile": on_refined(quality.visit_profile, REFINED_COLUMNS),
    # Clean, derive, export.
    "cleaned_visits": on_refined_only(quality.clean),
    "clean_counts": on_refined_only(quality.clean_counts),
    "visits_export": visits_export(),
    "visits_export_24h": visits_export("24h"),
    "export_cells": export_cells,
    "export_batches": export_batches,
    "export_csv_roundtrip": export_csv_roundtrip,
    "comments_csv_roundtrip": comments_csv_roundtrip,
    "published_outputs": published_outputs,
    **{f"published_{n}": published(shared_analysis_results, n) for n in ANALYSES},
    **{f"published_chart_{n}": published(shared_chart_results, n) for n in CHARTS},
    # Chart summaries.
    "monthly_visits": on_export(dashboards.monthly_visits),
    "hour_month_heat": on_export(dashboards.hour_month_heat),
    "hour_month_heat_24h": on_export(dashboards.hour_month_heat, "24h"),
    "export_top_visitors": on_export(analyses.top_visitors),
    "location_share": on_refined(dashboards.location_share),
    "arrival_gap_hist": on_refined(dashboards.arrival_gap_hist),
    "arrival_gap_hist_24h": on_refined(dashboards.arrival_gap_hist, "24h"),
    "export_location_share": on_export(dashboards.location_share),
    "export_arrival_gap_hist": on_export(dashboards.arrival_gap_hist),
    "export_arrival_gap_hist_24h": on_export(dashboards.arrival_gap_hist, "24h", "24h"),
    "export_top_comments": on_export(analyses.top_comments),
    "visit_kpis": on_cleaned(dashboards.visit_kpis),
    "visit_kpis_24h": on_cleaned(dashboards.visit_kpis, "24h"),
    # Other tables.
    "event_type_counts": on_table(
        "events", lambda t: split_counts(t, equals("event_type", "purchase"))
    ),
    "event_type_share": on_table("events", lambda t: group_shares(t, ["event_type"])),
    "first_order": on_table("orders", lambda t: earliest(t, "o_orderdate", tie_break=["o_orderkey"])),
    "last_shipment": on_table(
        "lineitem",
        lambda t: latest(t, "l_shipdate", tie_break=["l_orderkey", "l_linenumber"]).select(
            "l_orderkey", "l_linenumber", "l_shipdate"
        ),
    ),
    "top_part_names_sketched": on_table("part", lambda t: frequent_values(t, "p_name")),
    "top_document_sources_sketched": on_table("documents", lambda t: frequent_values(t, "source", 5)),
    "top_part_names": on_table("part", lambda t: top_k_values(t, "p_name")),
    "least_part_names": on_table("part", lambda t: bottom_k_values(t, "p_name")),
    "part_variation_rate": on_table("part", lambda t: match_rate(t, matches("p_name", PART_PATTERN))),
    "part_variation_values": on_table(
        "part", lambda t: first_distinct_values(t.filter(matches("p_name", PART_PATTERN)), "p_name")
    ),
    "top_customer_groups": on_table("customer", top_customer_groups),
    "monthly_orders": on_table("orders", monthly_orders),
    "document_source_counts": on_table("documents", lambda t: group_counts(t, ["lang", "source"])),
    "lineitem_null_rows": on_table("lineitem", null_row_counts),
    "lineitem_null_counts": on_table("lineitem", null_counts),
    "order_batches": on_table("orders", order_batches),
    "shipment_numbers": on_table("lineitem", shipment_numbers),
    "documents_csv_roundtrip": documents_csv_roundtrip,
}
