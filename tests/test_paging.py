import random
from contextlib import contextmanager

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import values, visits
from visitlog.operators import paging
from visitlog.operators.paging import assign_batches, number_rows
from visitlog.plans import export
from visitlog.session import stage


@contextmanager
def conf(spark, **options):
    keys = {k.replace("__", "."): v for k, v in options.items()}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _shuffled(spark, rows, schema, parts=6, seed=1):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_numbers_follow_the_sort_order(spark):
    rows = [(i % 7, f"v{i:04d}") for i in range(2500)] + [(None, "n"), (None, "m")]
    df = _shuffled(spark, rows, "k int, v string")
    got = sorted(values(number_rows(df, ["k", "v"], unique=True)), key=lambda r: r[2])
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == [(*r, n) for n, r in enumerate(ordered, 1)]


def test_order_may_be_a_column_expression(spark):
    df = _shuffled(spark, [(i,) for i in range(100)], "v int")
    got = dict(values(number_rows(df, [F.col("v").desc()], unique=True)))
    assert got == {i: 100 - i for i in range(100)}


def test_equal_keys_get_different_numbers(spark):
    rows = [("hot",)] * 400 + [(f"k{i}",) for i in range(800)]
    got = sorted(values(number_rows(_shuffled(spark, rows, "k string"), ["k"])), key=lambda r: r[1])
    assert [k for k, _ in got] == sorted(k for (k,) in rows)
    assert [n for _, n in got] == list(range(1, 1201))


def test_stored_order_needs_no_shuffle_of_rows(spark):
    df = _shuffled(spark, [(i,) for i in range(1000)], "v int")
    numbered = number_rows(df)
    assert sorted(n for _, n in values(numbered)) == list(range(1, 1001))
    assert sorted(v for v, _ in values(numbered)) == list(range(1000))


def test_a_run_of_equal_keys_is_split_over_tasks(spark, monkeypatch):
    """A third of all rows share one key; no sort task may hold them all."""
    staged = {}

    def remember(df, label, made=None):
        staged[label] = stage(df, label, made)
        return staged[label]

    monkeypatch.setattr(paging, "stage", remember)
    rows = [("hot", "x")] * 20000 + [(f"k{i}", "x") for i in range(40000)]
    df = _shuffled(spark, rows, "k string, v string")
    with conf(
        spark,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="12",
    ):
        numbered = number_rows(df, ["k"])
    assert numbered.agg(F.count_distinct("row_number")).first()[0] == 60000
    part = F.shiftrightunsigned("_place", paging.PLACE_BITS)
    sizes = [r["count"] for r in staged["placed"].groupBy(part).count().collect()]
    assert len(sizes) == 12
    assert max(sizes) < 2 * 60000 / 12


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 9, 10, 11, 23])
def test_pages_of_a_sheet(spark, rows):
    """The same pages as slicing [header, *rows] into runs of five."""
    df = _shuffled(spark, [(i,) for i in range(rows)], "v int")
    data = ["header", *range(rows)]
    expected = {
        (v, i + j + 1, i // 5, i + 1)
        for i in range(0, len(data), 5)
        for j, v in enumerate(data[i : i + 5])
        if v != "header"
    }
    assert set(values(assign_batches(df, ["v"], 5, unique=True))) == expected


def test_default_page_size(spark):
    df = spark.range(2500).select(F.col("id").alias("v"))
    sizes = {r.batch_id: r["count"] for r in assign_batches(df, ["v"]).groupBy("batch_id").count().collect()}
    assert sizes == {0: 999, 1: 1000, 2: 501}


def test_export_pages_hold_text_cells(spark):
    df = visits(spark, *[{"lname": f"L{i}"} for i in range(3)], {"fname": None})
    pages = export.export_batches(df, order_by=["lname"], size=2)
    assert {t for c, t in pages.dtypes[:9]} == {"string"}
    got = sorted((r.lname, r.sheet_row, r.batch_id, r.start_row) for r in pages.collect())
    assert got == [("L0", 2, 0, 1), ("L1", 3, 1, 3), ("L2", 4, 1, 3)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.sampled_from("abc")), max_size=40), st.integers(1, 7))
def test_any_rows_any_page_size(spark, keys, size):
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(3)
    rows = sorted(values(assign_batches(df, ["k"], size)), key=lambda r: r[1])
    assert [r[0] for r in rows] == sorted(keys, key=lambda k: (k is not None, k or ""))
    assert [r[1] for r in rows] == list(range(2, len(keys) + 2))
    assert all(start == b * size + 1 and start <= row < start + size for _, row, b, start in rows)


def test_wrong_unique_raises(spark, tmp_path):
    df = _shuffled(spark, [(i % 50, f"v{i}") for i in range(300)], "k int, v string")
    staged = []
    with pytest.raises(paging.NotUnique, match="6 rows agree on k"):
        number_rows(df, ["k"], unique=True, staged=staged)
    assert not staged
    with pytest.raises(paging.NotUnique):
        assign_batches(_shuffled(spark, [(None,), (None,), (1,)], "k int"), ["k"], unique=True)
    # Expressions cannot be checked, so they get a tie-break, as without ``unique``.
    got = sorted(n for *_, n in values(number_rows(df, [F.col("k").desc()], unique=True)))
    assert got == list(range(1, 301))


def test_unique_is_checked_without_a_shuffle(spark):
    from pyspark.sql import Window

    from tests.helpers import plan_text

    df = spark.range(0, 1000, 1, 5).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"))
    ordered = df.orderBy(F.col("k").asc_nulls_first(), F.col("v").asc_nulls_first())
    checked = ordered.withColumn("n", F.row_number().over(Window.partitionBy("k", "v").orderBy("k", "v")))
    plan = plan_text(checked)
    assert "rangepartitioning" in plan and "hashpartitioning(" not in plan


def test_sample_is_the_same_for_any_partitioning(spark):
    from visitlog.operators.reshape import uniform_sample

    rows = [(i, None if i % 3 else f"t{i}") for i in range(500)]
    samples = {
        tuple(sorted(map(str, uniform_sample(_shuffled(spark, rows, "i int, t string", parts, parts), 10).collect())))
        for parts in (1, 4, 9)
    }
    assert len(samples) == 1 and len(next(iter(samples))) == 10
    df = spark.createDataFrame(rows, "i int, t string")
    other = sorted(map(str, uniform_sample(df, 10, seed=1).collect()))
    assert tuple(other) not in samples
    # By chance: all parts of the table are drawn from.
    drawn = [r.i for r in uniform_sample(df, 200, seed=2).collect()]
    assert 200 < sum(drawn) / len(drawn) < 300 and uniform_sample(df, 0).collect() == []
