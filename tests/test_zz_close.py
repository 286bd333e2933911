"""Runs last: what the queries of this session have left behind goes with their run."""

from pathlib import Path

from checks.registry import QUERIES
from visitlog.session import close_run

SF_DIR = "/root/testdata/sf0.001"


def test_closing_a_run_leaves_nothing(spark):
    for query in QUERIES.values():
        query(spark, SF_DIR)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert any(shared.glob("visitlog-run-*"))
    assert any(t.name.startswith("visits_refined_") for t in spark.catalog.listTables())
    close_run(spark)
    assert not any(shared.glob("visitlog-*"))
    assert not any(t.name.startswith("visits_refined_") for t in spark.catalog.listTables())
