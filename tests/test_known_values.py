"""Figures of the derived log at sf0.01, counted independently beforehand."""

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES, refined, visits
from tests.helpers import one
from visitlog.functions.predicates import not_blank
from visitlog.functions.timeparse import parse_visit_ts

SF_DIR = "/root/testdata/sf0.01"


def _run(spark, name):
    return QUERIES[name](spark, SF_DIR)


def test_rows(spark):
    assert one(_run(spark, "refine_counts")) == {
        "raw_rows": 10000, "kept_rows": 1981, "filtered_out": 8019,
    }
    assert one(_run(spark, "clean_counts"))["clean_rows"] == 1073


def test_nulls(spark):
    assert list(one(_run(spark, "null_counts")).values()) == [18, 0, 193, 144, 103, 161]
    profile = one(_run(spark, "null_row_profile"))
    assert (profile["null_rows"], profile["percent_null"]) == (558, 28.1676)
    assert one(_run(spark, "missing_purpose_rate"))["missing_count"] == 317


def test_rankings(spark):
    assert tuple(_run(spark, "top_visitors").first()) == ("F6 L1", 24)
    assert tuple(_run(spark, "top_comments").first()) == ("GEN RECEP", 175)
    assert tuple(_run(spark, "least_comments").first()) == ("TOUR 4", 20)
    assert one(_run(spark, "variation_rate"))["matching_rows"] == 653
    assert _run(spark, "variation_values").count() == 4


@pytest.mark.parametrize(
    "name,event_id",
    [("first_visitor", 7), ("first_visitor_24h", 7), ("last_visitor", 9822), ("last_visitor_24h", 9992)],
)
def test_first_and_last(spark, name, event_id):
    row = visits(spark, SF_DIR).filter(F.col("event_id") == event_id).drop("event_id", "visitee")
    assert one(_run(spark, name)) == one(row)


def test_arrivals(spark):
    rows = refined(spark, SF_DIR).filter(not_blank("time_of_arrival"))
    assert rows.count() == 1667
    assert rows.filter(parse_visit_ts("time_of_arrival").isNull()).count() == 857
    assert rows.filter(parse_visit_ts("time_of_arrival", "24h").isNull()).count() == 0
    locations = visits(spark, SF_DIR).groupBy("meeting_location").count().collect()
    assert {r.meeting_location: r["count"] for r in locations} == {None: 527, "OEOB": 2841, "WH": 6632}
    midnight = visits(spark, SF_DIR).filter(F.hour(parse_visit_ts("time_of_arrival")) == 0)
    noon = visits(spark, SF_DIR).filter(F.hour(parse_visit_ts("time_of_arrival", "24h")) == 12)
    assert midnight.count() == noon.count() == 341


def test_text_table_is_exported_whole(spark):
    assert _run(spark, "documents_csv_roundtrip").agg(F.sum(F.length("text"))).first() == (
        spark.read.parquet(f"{SF_DIR}/documents.parquet").agg(F.sum(F.length("text"))).first()
    )
