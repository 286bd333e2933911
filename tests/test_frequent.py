"""Frequent values by sketch and exact second pass."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_text, values
from visitlog.operators import frequent
from visitlog.operators.frequent import frequent_values
from visitlog.operators.ranking import top_k_values
from visitlog.session import release


def mixed(spark, n=20_000, hot=12, share=3):
    """A third of the rows in a few values, one of them NULL; the others occur once."""
    hottest = F.pmod(F.xxhash64("id"), F.lit(hot))
    value = F.when(F.col("id") % share == 0, F.when(hottest > 0, F.concat(F.lit("hot"), hottest))).otherwise(
        F.concat(F.lit("v"), F.col("id"))
    )
    return spark.range(0, n, 1, 6).select(value.alias("v"), F.lit(1).alias("count"))


@pytest.fixture
def full_groupings(monkeypatch):
    """How often all values were grouped."""
    calls, real = [], frequent.group_counts

    def counted(df, keys, name):
        calls.append(name)
        return real(df, keys, name)

    monkeypatch.setattr(frequent, "group_counts", counted)
    return lambda: len(calls) - 1


def test_hot_values_need_no_full_grouping(spark, full_groupings):
    df = mixed(spark)
    want = values(top_k_values(df, "v", 12))
    assert values(frequent_values(df, "v", 12, tracked=1000)) == want
    assert any(v is None for v, _ in want) and full_groupings() == 0


def test_what_cannot_be_told_apart_is_grouped(spark, full_groupings):
    df = mixed(spark)
    assert values(frequent_values(df, "v", 20, tracked=1000)) == values(top_k_values(df, "v", 20))
    assert full_groupings() == 1
    # A sketch too small for the k-th value, and values that all occur alike often.
    assert values(frequent_values(df, "v", 3, tracked=16)) == values(top_k_values(df, "v", 3))
    even = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("v"))
    assert values(frequent_values(even, "v", 5, tracked=64)) == values(top_k_values(even, "v", 5))


def test_few_and_no_rows(spark):
    for rows in ([], [(None,)], [("a",), ("a",), ("b",), (None,)]):
        df = spark.createDataFrame(rows, "v string")
        for k in (1, 10):
            assert values(frequent_values(df, "v", k)) == values(top_k_values(df, "v", k))


def test_skewed_counts(spark):
    dice = random.Random(11)
    rows = [(int(dice.paretovariate(0.9)),) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "n long").repartition(5)
    for k, tracked in ((5, 200), (10, 2000), (40, 500)):
        assert values(frequent_values(df, "n", k, tracked)) == values(top_k_values(df, "n", k))


def test_only_named_values_are_shuffled(spark):
    df, staged = mixed(spark, n=60_000), []
    top = frequent_values(df, "v", 10, tracked=1000, staged=staged)
    assert len(staged) == 2
    # The counts that were shuffled and stored: the hot values only.
    assert spark.read.parquet(staged[1]).count() <= 13
    assert "Exchange hashpartitioning" not in plan_text(top)
    release(spark, staged)
