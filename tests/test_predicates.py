import pytest
from pyspark.sql import functions as F

from visitlog.functions import predicates as p
from visitlog.functions.text import joined

TEXTS = [None, "", " ", "   ", "x", " x ", "\t", "POTUS", "potus", " POTUS"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "t string")


def _kept(texts, condition):
    return [r.t for r in texts.filter(condition).collect()]


def test_three_notions_of_nothing(texts):
    assert _kept(texts, p.is_null("t")) == [None]
    assert _kept(texts, p.is_empty("t")) == [None, ""]


@pytest.mark.parametrize(
    "yes,no", [(p.is_null, p.not_null), (p.is_empty, p.not_empty)]
)
def test_complements_split_the_rows_and_are_never_null(texts, yes, no):
    flags = texts.select(yes("t").alias("y"), no("t").alias("n")).collect()
    assert all(r.y is not None and r.n is (not r.y) for r in flags)


def test_equals_is_exact(texts):
    assert _kept(texts, p.equals("t", "POTUS")) == ["POTUS"]


def test_matches_ignores_case_and_stops_at_line_breaks(spark):
    rows = ["gen recep", "x Gen. Recep y", "GEN\nRECEP", "RECEP GEN", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    assert _kept(df, p.matches("t", "GEN.*RECEP|GENERAL.*RECEPTION")) == rows[:2]


def test_all_and_any(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), (None, None)], "x string, y string")
    assert df.filter(p.all_of(p.not_null, ["x", "y"])).count() == 1
    assert df.filter(p.all_of(p.is_null, [])).count() == 3


def test_joined_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("  ", "b")], "x string, y string")
    assert [r[0] for r in df.select(joined("x", "y")).collect()] == ["a b", None, "   b"]
    assert df.select(joined(F.lit(1).cast("string"), "x", sep="-")).first()[0] == "1-a"
