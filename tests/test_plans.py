"""The physical plans that large inputs need."""

import re

import pytest

from __spark_entry__ import entry
from checks.registry import QUERIES
from tests.helpers import plan_text
from visitlog.functions.predicates import not_empty
from visitlog.operators.counting import group_counts, group_shares, null_counts
from visitlog.operators import paging
from visitlog.operators.paging import number_rows
from visitlog.operators.ranking import top_k_values
from visitlog.plans import analyses, dashboards, export, quality
from visitlog.plans.refine import refine
from visitlog.schema import REFINED_COLUMNS
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.derived import as_positional, visits_from_events
from visitlog.session import stage
from visitlog.sinks.csvfiles import export_csv

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Refined visits as a columnar file."""
    path = str(tmp_path_factory.mktemp("plans") / "refined")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    refine(as_positional(visits_from_events(events))).write.parquet(path)
    return spark.read.parquet(path)


def _read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", plan)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython",
                "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan


def test_flagship_runs(spark):
    df = entry(spark)
    assert df.columns == ["visitor_full_name", "count"]
    assert 1 <= df.count() <= 20


def test_raw_scan_gets_the_filter_and_reads_seven_columns(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    export_csv(as_positional(visits_from_events(events)), str(tmp_path / "log"), header=False)
    plan = plan_text(refine(read_positional_csv(spark, str(tmp_path / "log"))))
    assert "EqualTo(_c19,POTUS)" in plan
    assert _read_columns(plan) == [{"_c0", "_c1", "_c6", "_c11", "_c19", "_c21", "_c25"}]
    assert "Exchange" not in plan


def test_analyses_read_only_their_columns(stored):
    for df, columns in [
        (analyses.top_comments(stored), {"info_comment"}),
        (analyses.variation_rate(stored), {"info_comment"}),
        (analyses.top_visitors(stored), {"fname", "lname"}),
        (quality.missing_purpose_rate(stored), {"info_comment"}),
        (dashboards.arrival_gap_hist(stored), {"time_of_arrival", "appt_scheduled_time"}),
        (null_counts(stored, ["lname"]), {"lname"}),
    ]:
        assert _read_columns(plan_text(df)) == [columns]


def test_presence_reaches_the_scan(stored):
    assert "IsNotNull(time_of_arrival)" in plan_text(analyses.first_visitor(stored))
    plan = plan_text(stored.filter(not_empty("info_comment")))
    assert "Not(EqualTo(info_comment,))" in plan


def test_rankings_are_top_k_without_a_full_sort(stored):
    for df in (analyses.first_visitor(stored), analyses.last_visitor(stored),
               analyses.top_visitors(stored), analyses.least_comments(stored),
               analyses.variation_values(stored), top_k_values(stored, "lname")):
        plan = plan_text(df)
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan and "Window" not in plan


def test_groups_are_counted_before_the_shuffle(stored):
    plan = plan_text(group_counts(stored, ["meeting_location"]))
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_count" in plan[exchange:]
    assert plan.count("Exchange hashpartitioning") == 1


def test_counters_take_one_scan(stored):
    plan = plan_text(quality.visit_profile(stored, REFINED_COLUMNS))
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("order_by", [None, ["lname"]])
def test_numbering_moves_no_rows_after_the_sort(stored, order_by):
    plan = plan_text(number_rows(stored, order_by))
    assert plan.count("BroadcastHashJoin") == 1
    assert {"_partition", "_offset"} in _read_columns(plan)
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_offsets_are_only_broadcast_below_the_threshold(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = number_rows(stored, ["lname"])
        assert "BroadcastHashJoin" not in plan_text(numbered)
        numbers = sorted(r.row_number for r in numbered.collect())
        assert numbers == list(range(1, stored.count() + 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_share_total_reuses_the_grouping(stored):
    df = group_shares(stored, ["meeting_location"])
    df.collect()
    final = plan_text(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and "Window" not in plan_text(df)


def test_export_is_narrow(stored):
    assert "Exchange" not in plan_text(export.export_cells(stored))


def test_pages_are_numbered_before_times_are_parsed(stored, monkeypatch):
    sorted_plans = []

    def remember(df, label, staged=None):
        sorted_plans.append(plan_text(df))
        return stage(df, label, staged)

    monkeypatch.setattr(paging, "stage", remember)
    pages = export.export_batches(stored, order_by=REFINED_COLUMNS)
    assert any("rangepartitioning" in p for p in sorted_plans)
    assert not any("gettimestamp" in p for p in sorted_plans)
    assert plan_text(pages).count("gettimestamp") == 1


def test_each_time_is_parsed_once(stored):
    for df, times in [
        (export.export_cells(stored), 1),
        (analyses.first_visitor(stored), 1),
        (analyses.last_visitor(stored, require_parsed=True), 1),
        (dashboards.arrival_gap_hist(stored), 2),
        (dashboards.visit_kpis(quality.clean(stored)), 2),
    ]:
        assert plan_text(df).count("gettimestamp") == times
