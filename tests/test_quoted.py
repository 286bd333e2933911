"""Quoted CSV in splits, against Spark's own reader of whole files."""

import random

import pytest

from tests.helpers import plan_text
from visitlog.schema import positional_schema
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.landing import land_csv_if_absent
from visitlog.sources.quoted import read_quoted_csv, read_quoted_records

CELLS = [
    "", "plain", " sp ace ", '"q,uo""ted"', '"line\nbreak"', '"a\n\nb,""\n"', 'str"ay', '"x" junk', '"\r\n"', '""',
    '""""', '"""\n"""', "é ", '"日本\n語"', '"' + "long,\n" * 40 + '"',
]


def whole_files(spark, path, width, sep=",", line_sep="\n"):
    reader = spark.read.schema(positional_schema(width)).option("escape", '"').option("multiLine", True)
    return reader.option("sep", sep).option("lineSep", line_sep).csv(str(path))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def split_bytes(spark):
    """Set the size of splits; back to the session's afterwards."""
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = [spark.conf.get(n) for n in names]

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")

    yield set_to
    for n, value in zip(names, old):
        spark.conf.set(n, value)


def write(path, n, dice, sep=","):
    with open(path, "w", newline="", encoding="utf-8") as f:
        for i in range(n):
            f.write(sep.join([str(i)] + [dice.choice(CELLS).replace(",", sep) for _ in range(dice.randint(0, 4))]) + "\n")
            if dice.random() < 0.05:
                f.write("\n")


@pytest.mark.parametrize("size", ["1m", "900b", "64b"])
def test_splits_equal_whole_files(spark, tmp_path, split_bytes, size):
    dice = random.Random(7)
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, n in (("a", 200), ("b", 3), ("c", 90)):
        write(folder / f"{name}.csv", n, dice)
    (folder / "empty.csv").write_text("")
    want = rows(whole_files(spark, folder, 5))
    split_bytes(size)
    lines = spark.read.text(str(folder / "a.csv")).rdd.getNumPartitions()
    assert lines > 50 or size != "64b"
    assert rows(read_quoted_csv(spark, str(folder), 5)) == want


@pytest.mark.parametrize("text", [
    'a,"b\nc",d\n', '"unclosed\nrest,1\nof it', 'a\n"b"', '\n\n\n', '"\n"\n"\n"\n', 'a,"\nb', ',,,\n"",,"",\n', '"a""\n""b","c\n"""\n',
    'x"y,"z\n"\nq"\n', '"a"b"c\nd\n', '"1\n2"3,"4\n5"\n6\n', "one\n",
])
@pytest.mark.parametrize("size", ["3b", "7b"])
def test_odd_files(spark, tmp_path, split_bytes, text, size):
    path = tmp_path / "odd.csv"
    path.write_bytes(text.encode())
    want = rows(whole_files(spark, path, 4))
    split_bytes(size)
    assert rows(read_quoted_csv(spark, str(path), 4)) == want


def test_separators_and_line_ends(spark, tmp_path, split_bytes):
    path, other = tmp_path / "a.csv", tmp_path / "b.csv"
    write(path, 60, random.Random(1), sep=";")
    other.write_bytes(b'a,"b\r\nc"\r\nd,"e\rf"\r\n')
    want = rows(whole_files(spark, path, 5, ";"))
    split_bytes("100b")
    assert rows(read_positional_csv(spark, str(path), 5, ";", rfc4180=True, line_sep="\n")) == want
    got = read_positional_csv(spark, str(other), 2, rfc4180=True).collect()
    assert sorted(tuple(r) for r in got) == [("a", "b\nc"), ("d", "e\nf")]


def test_records_come_out_whole(spark, tmp_path, split_bytes):
    path = tmp_path / "a.csv"
    path.write_text("".join(f'{i},"' + "line\n" * i + '"\n' for i in range(40)))
    split_bytes("50b")
    got = sorted((r.value for r in read_quoted_records(spark, str(path)).collect()), key=lambda v: int(v.split(",")[0]))
    assert got == [f'{i},"' + "line\n" * i + '"' for i in range(40)]


def test_landing_deals_one_file_out(spark, tmp_path, split_bytes):
    path, landed = tmp_path / "raw.csv", str(tmp_path / "landed")
    write(path, 300, random.Random(2))
    want = rows(whole_files(spark, path, 5))
    split_bytes("2k")
    assert land_csv_if_absent(spark, str(path), landed, width=5)
    assert len(list((tmp_path / "landed").glob("part-*"))) > 1
    split_bytes("1k")
    assert rows(read_quoted_csv(spark, landed, 5)) == want


def test_lines_are_shuffled_once(spark, tmp_path, split_bytes):
    path = tmp_path / "a.csv"
    write(path, 50, random.Random(2))
    split_bytes("200b")
    df = read_quoted_csv(spark, str(path), 5)
    df.collect()
    plan = plan_text(df)
    assert "Python" not in plan and "InArrow" not in plan
    # By split, reused for both kinds of pieces.
    assert plan.split("Initial Plan")[0].count("ReusedExchange") >= 1
