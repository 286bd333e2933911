"""Results must not change when tasks fail half-way and are run again."""

import pytest
from pyspark import TaskContext

from tests.helpers import one, values
from visitlog.operators.paging import number_rows
from visitlog.plans.refine import refine, refine_to_table
from visitlog.schema import RAW_WIDTH, VISITEE_POSITION, positional_schema
from visitlog.sinks.csvfiles import export_csv
from visitlog.sources.delimited import read_exported_csv
from visitlog.sources.tables import read_refined


def _fail_once(batches):
    """Hand on half of the rows, then fail, unless this is the second attempt."""
    first = TaskContext.get().attemptNumber() == 0
    for batch in batches:
        if first and len(batch):
            yield batch.head(len(batch) // 2)
            raise RuntimeError("lost on purpose")
        yield batch


def flaky(df):
    return df.mapInPandas(_fail_once, df.schema)


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        tuple(("POTUS" if n % 3 else "other") if i == VISITEE_POSITION else f"{i}:{n}"
              for i in range(RAW_WIDTH))
        for n in range(300)
    ]
    return spark.createDataFrame(rows, positional_schema()).repartition(5)


@pytest.mark.parametrize("compact", [False, True])
def test_counters_and_table(spark, log, compact):
    counts = one(refine_to_table(flaky(log), "flaky_refined", compact=compact))
    assert counts == {
        "raw_rows": 300, "kept_rows": 200, "filtered_out": 100, "written_rows": 200, "complete": True,
    }
    assert sorted(values(read_refined(spark, "flaky_refined"))) == sorted(values(refine(log)))


@pytest.mark.parametrize("order_by,unique", [(None, False), (["lname"], True), (["lname"], False)])
def test_numbers_have_no_gap_and_no_repeat(log, order_by, unique):
    rows = refine(log).select("lname")
    got = values(number_rows(flaky(rows), order_by, unique))
    assert sorted(n for _, n in got) == list(range(1, 201))
    assert sorted(v for v, _ in got) == sorted(r.lname for r in rows.collect())
    if order_by:
        by_number = [v for v, _ in sorted(got, key=lambda r: r[1])]
        assert by_number == sorted(by_number)


def test_export(spark, log, tmp_path):
    rows = refine(log)
    export_csv(flaky(rows), str(tmp_path / "out"))
    back = read_exported_csv(spark, str(tmp_path / "out"), rows.schema)
    assert sorted(values(back)) == sorted(values(rows))
