"""Columns named like the helpers come back unchanged."""

from pyspark.sql import functions as F

from visitlog.functions.timeparse import with_time_parts
from visitlog.operators.names import free_name
from visitlog.operators.paging import assign_batches, number_rows
from visitlog.operators.ranking import earliest, earliest_and_latest, latest

HELPERS = ["_key", "_none", "_tie", "_place", "_partition", "_offset", "_rows", "_number", "_ts"]


def frame(spark):
    rows = [(i, *[f"{h}{i}" for h in HELPERS]) for i in range(5)]
    return spark.createDataFrame(rows, ["v", *HELPERS]), rows


def test_free_name():
    assert free_name(["a"], "_x") == "_x"
    assert free_name(["_X", "_x_"], "_x") == "_x__"


def test_rankings(spark):
    df, rows = frame(spark)
    assert [tuple(r) for r in earliest(df, "v").collect()] == rows[:1]
    assert [tuple(r) for r in latest(df, F.col("v") * 2).collect()] == rows[-1:]
    ends = earliest_and_latest(df, F.col("v")).first()
    assert (tuple(ends.earliest), tuple(ends.latest)) == (rows[0], rows[-1])


def test_numbers_and_pages(spark):
    df, rows = frame(spark)
    for unique in (True, False):
        got = sorted(number_rows(df, ["v"], unique).collect())
        assert [tuple(r)[:-1] for r in got] == rows
        assert [r.row_number for r in got] == [1, 2, 3, 4, 5]
    assert [tuple(r)[:-3] for r in sorted(assign_batches(df, ["v"]).collect())] == rows


def test_time_parts(spark):
    df, rows = frame(spark)
    got = sorted(with_time_parts(df, F.lit("2010-01-02").cast("timestamp"), year="y").collect())
    assert [tuple(r) for r in got] == [(*r, 2010) for r in rows]
