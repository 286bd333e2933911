import csv
import io
from pathlib import Path

from pyspark.sql import types as T

from tests.helpers import values
from visitlog.operators.reshape import leading_columns, select_positions, stringify_cells
from visitlog.sinks.csvfiles import export_csv
from visitlog.sources.delimited import read_exported_csv, read_positional_csv

LINES = (
    'a,,"",d\n'
    ' a , ,"x,y",POTUS\n'
    "short,row\n"
    "long,1,2,3,4,5\n"
    "\n"
    'q,"he said ""hi""",2,3\n'
    ",,,\n"
)

CELLS = [
    ("plain", "a,b", 'say "hi"'),
    ("", " outer ", "back\\slash"),
    ("line\nbreak", "carriage\rreturn", "both\r\nends"),
    ("ünï", "'single'", '"'),
    ("#hash", "a\tb", "x"),
    (",", '""', "\\\""),
]
CELL_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def _write(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text)
    return str(path)


def test_positional_rows(spark, tmp_path):
    df = read_positional_csv(spark, _write(tmp_path, LINES), width=4)
    assert df.columns == ["_c0", "_c1", "_c2", "_c3"]
    rows = values(df)
    assert rows[:4] == [
        ("a", None, None, "d"),
        (" a ", " ", "x,y", "POTUS"),
        ("short", "row", None, None),
        ("long", "1", "2", "3"),
    ]
    assert rows[4][0] == "q" and '""hi""' in rows[4][1]
    assert rows[5] == (None, None, None, None)
    assert len(rows) == 6


def test_short_first_line_does_not_set_the_width(spark, tmp_path):
    df = read_positional_csv(spark, _write(tmp_path, "only\na,b,c\n"), width=26)
    assert len(df.columns) == 26
    assert [tuple(r[:3]) for r in df.collect()] == [("only", None, None), ("a", "b", "c")]


def test_rfc4180_quotes_and_line_breaks(spark, tmp_path):
    path = _write(tmp_path, 'a,"one\ntwo",x\nb,"say ""hi""",y\n')
    assert values(read_positional_csv(spark, path, 3, rfc4180=True)) == [
        ("a", "one\ntwo", "x"),
        ("b", 'say "hi"', "y"),
    ]
    assert read_positional_csv(spark, path, 3).count() == 3


def test_other_separator(spark, tmp_path):
    assert values(read_positional_csv(spark, _write(tmp_path, "a|b\n"), 2, sep="|")) == [("a", "b")]


def test_export_bytes_equal_the_csv_module(spark, tmp_path):
    df = spark.createDataFrame(CELLS, CELL_SCHEMA).coalesce(1)
    export_csv(df, str(tmp_path / "out"))
    (part,) = Path(tmp_path / "out").glob("part-*.csv")
    text = part.read_bytes().decode()
    expected = io.StringIO()
    csv.writer(expected, lineterminator="\n").writerows([df.columns, *CELLS])
    # Spark also quotes a leading "#"; readers see the same cell.
    assert text.replace('"#hash"', "#hash") == expected.getvalue()
    assert [tuple(r) for r in csv.reader(io.StringIO(text, newline=""))] == [tuple("abc"), *CELLS]


def test_export_round_trip_and_replacement(spark, tmp_path):
    out = str(tmp_path / "out")
    export_csv(spark.createDataFrame([("old", "old", "old")], CELL_SCHEMA), out)
    export_csv(spark.createDataFrame(CELLS, CELL_SCHEMA), out)
    back = read_exported_csv(spark, out, CELL_SCHEMA, multi_line=True)
    expected = [tuple(v or None for v in row) for row in CELLS]
    assert sorted(values(back), key=str) == sorted(expected, key=str)


def test_every_part_has_a_header_even_when_empty(spark, tmp_path):
    out = tmp_path / "out"
    export_csv(spark.createDataFrame([], CELL_SCHEMA), str(out))
    assert {p.read_text() for p in out.glob("part-*.csv")} == {"a,b,c\n"}


def test_reshape(spark):
    df = spark.createDataFrame([("a", "b", None, 1)], "_c0 string, _c1 string, _c2 string, _c3 int")
    assert leading_columns(df, 2).columns == ["_c0", "_c1"]
    picked = select_positions(df, {2: "z", 0: "x"}, keep=["_c3"])
    assert picked.columns == ["_c3", "z", "x"]
    cells = stringify_cells(picked)
    assert {t for _, t in cells.dtypes} == {"string"}
    assert values(cells) == [("1", "", "a")]
    assert values(stringify_cells(picked, ["z"])) == [(1, "", "a")]


def test_no_row_of_a_single_column_is_lost(spark, tmp_path):
    cells = ["a", "", None, " ", "   ", 'q"x, b']
    df = spark.createDataFrame([(c,) for c in cells], "c string").coalesce(1)
    export_csv(df, str(tmp_path / "out"))
    (part,) = Path(tmp_path / "out").glob("part-*.csv")
    text = part.read_bytes().decode()
    assert text == '"c"\n"a"\n""\n""\n" "\n"   "\n"q""x, b"\n'
    back = values(read_exported_csv(spark, str(tmp_path / "out"), df.schema))
    assert back == [(c or None,) for c in cells]
