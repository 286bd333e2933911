"""The daily run over new files, digests of contents, and tables replaced whole."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.registry import CHARTS, visits
from tests.helpers import one, values
from visitlog.operators.digest import content_digest
from visitlog.plans import incremental
from visitlog.plans.incremental import ChangedFile, merged_charts, read_batches, read_manifest, refine_new_files
from visitlog.plans.refine import refine
from visitlog.plans.report import shared_chart_results
from visitlog.sinks import versions
from visitlog.sinks.csvfiles import export_csv
from visitlog.sinks.tables import save_refined, verify_written
from visitlog.sinks.versions import NotWritten, replace_table, write_checked
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.derived import as_positional

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Three days of the derived log."""
    folder = str(tmp_path_factory.mktemp("log") / "with space [a]")
    for day in range(3):
        arrived = visits(spark, SF_DIR).filter(F.col("event_id") % 3 == day)
        export_csv(as_positional(arrived).repartition(2), f"{folder}/day-{day}", header=False)
    return folder


def link(log, to, *days):
    """A folder with the files of some days, unchanged."""
    for day in days:
        for f in Path(log, f"day-{day}").glob("part-*"):
            Path(to, f"day-{day}").mkdir(parents=True, exist_ok=True)
            os.link(f, Path(to, f"day-{day}", f.name))


def test_batches_equal_one_run(spark, log, tmp_path):
    arrived, base = tmp_path / "arrived", str(tmp_path / "base")
    counts = []
    for day in range(3):
        link(log, arrived, day)
        counts.append(one(refine_new_files(spark, str(arrived), base)))
    assert [c["new_files"] for c in counts] == [2, 2, 2] and counts[-1]["all_files"] == 6
    whole = refine(read_positional_csv(spark, [incremental.escaped(f"{log}/day-{d}") for d in range(3)]))
    assert rows(read_batches(spark, base)) == rows(whole)
    assert counts[-1]["all_rows"] == whole.count() == sum(c["new_rows"] for c in counts)
    charts = merged_charts(spark, base)
    with shared_chart_results(whole) as results:
        for name in CHARTS:
            assert rows(charts[name].select(*results[name].columns)) == rows(results[name]), name
    # Again: no new file, nothing written.
    before = sorted(str(p) for p in Path(base).rglob("*"))
    again = one(refine_new_files(spark, str(arrived), base))
    assert (again["new_files"], again["new_rows"], again["all_rows"]) == (0, 0, counts[-1]["all_rows"])
    assert sorted(str(p) for p in Path(base).rglob("*")) == before


def test_only_new_files_are_read(spark, log, tmp_path):
    arrived, base = tmp_path / "arrived", str(tmp_path / "base")
    link(log, arrived, 0)
    refine_new_files(spark, str(arrived), base)
    # What is known is not opened again: it could not be read.
    for f in Path(arrived, "day-0").iterdir():
        stat, size = f.stat(), f.stat().st_size
        f.unlink()
        f.write_bytes(b"\xff" * size)
        os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    link(log, arrived, 1)
    assert one(refine_new_files(spark, str(arrived), base))["new_files"] == 2
    days = read_positional_csv(spark, [incremental.escaped(f"{log}/day-{d}") for d in (0, 1)])
    assert rows(read_batches(spark, base)) == rows(refine(days))


@pytest.mark.parametrize("step", ["write_checked", "partial_sums", "_write_manifest"])
def test_failed_run_is_repeated(spark, log, tmp_path, monkeypatch, step):
    arrived, base = tmp_path / "arrived", str(tmp_path / "base")
    link(log, arrived, 0)
    refine_new_files(spark, str(arrived), base)
    before = rows(read_batches(spark, base))
    link(log, arrived, 1)
    real = getattr(incremental, step)

    def fails(*args, **kwargs):
        if step == "write_checked":
            real(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, step, fails)
        with pytest.raises(RuntimeError):
            refine_new_files(spark, str(arrived), base)
    assert rows(read_batches(spark, base)) == before
    assert one(refine_new_files(spark, str(arrived), base))["new_files"] == 2
    days = read_positional_csv(spark, [incremental.escaped(f"{log}/day-{d}") for d in (0, 1)])
    assert rows(read_batches(spark, base)) == rows(refine(days))


def test_changed_and_touched_files(spark, log, tmp_path):
    arrived, base = tmp_path / "arrived", str(tmp_path / "base")
    link(log, arrived, 0)
    refine_new_files(spark, str(arrived), base)
    before = rows(read_batches(spark, base))
    file = next(f for f in sorted(Path(arrived, "day-0").iterdir()) if f.stat().st_size)
    text = file.read_bytes()
    file.unlink()
    file.write_bytes(text)
    os.utime(file, (1, 1))
    assert one(refine_new_files(spark, str(arrived), base))["new_files"] == 0
    assert rows(read_batches(spark, base)) == before
    # Known now: not even read.
    assert one(refine_new_files(spark, str(arrived), base))["new_files"] == 0
    lines = text.split(b"\n")
    file.write_bytes(b"\n".join(lines[:-2]) + b"\n")
    with pytest.raises(ChangedFile, match="1 files"):
        refine_new_files(spark, str(arrived), base)
    assert rows(read_batches(spark, base)) == before


def test_no_files(spark, tmp_path):
    (tmp_path / "log").mkdir()
    base = str(tmp_path / "base")
    got = one(refine_new_files(spark, str(tmp_path / "log"), base))
    assert set(got.values()) == {0}
    assert read_batches(spark, base).collect() == read_manifest(spark, base).collect() == []
    assert merged_charts(spark, base)["monthly_visits"].collect() == []
    assert one(merged_charts(spark, base)["visit_kpis"])["total_visits"] == 0


CELLS = [("a", None, 1), (None, "a", 1), ("b", "c", 2), ("b", "c", 2)]


def test_digest_tells_contents(spark):
    def digest(rows):
        return tuple(content_digest(spark.createDataFrame(rows, "x string, y string, n int")).first())

    same = digest(CELLS)
    assert digest(CELLS[::-1]) == same and same[0] == 4
    others = [
        CELLS[:3], CELLS + CELLS[2:3], [CELLS[1], CELLS[1], *CELLS[2:]], [("a", None, 1), ("a", None, 1), *CELLS[2:]],
        [("a", "", 1), *CELLS[1:]], [*CELLS[:2], ("c", "b", 2), ("b", "c", 2)], [*CELLS[:2]], [],
    ]
    assert len({digest(o) for o in others} | {same}) == len(others) + 1
    by_key = content_digest(spark.createDataFrame(CELLS, "x string, y string, n int"), ["n"])
    assert sorted(r["rows"] for r in by_key.collect()) == [2, 2]


def test_swapped_cells_on_disk_are_found(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame([("a", "b"), ("c", "d"), ("e", None)], "x string, y string").coalesce(1)
    save_refined(df, "swapped", fmt="csv", path=path)
    want = content_digest(df).first()
    checked = one(verify_written(spark, "swapped", 3, df.schema, want["digest"]))
    assert checked == {"written_rows": 3, "expected_rows": 3, "rows_match": True, "schema_matches": True, "content_matches": True}
    (part,) = Path(path).glob("part-*.csv")
    part.write_text(part.read_text().replace("a,b", "b,a"))
    for crc in Path(path).glob(".*.crc"):
        crc.unlink()
    spark.catalog.refreshTable("swapped")
    checked = one(verify_written(spark, "swapped", 3, df.schema, want["digest"]))
    assert checked["rows_match"] and checked["schema_matches"] and not checked["content_matches"]
    spark.sql("DROP TABLE swapped")


def test_replacing_leaves_no_gap(spark, tmp_path, monkeypatch):
    base, name = str(tmp_path / "ver's ions"), "replaced"
    first = spark.range(5).select(F.col("id").alias("n"), F.lit("a").alias("x"))
    replace_table(first, name, base)
    old = values(spark.table(name).orderBy("n"))

    bad = first.withColumn("x", F.when(F.col("n") == 3, F.raise_error(F.lit("lost"))).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        replace_table(bad, name, base)
    assert values(spark.table(name).orderBy("n")) == old
    with monkeypatch.context() as m:
        # Something else than what was written is found.
        m.setattr(versions, "content_digest", lambda df: content_digest(df.limit(1)))
        with pytest.raises(NotWritten):
            replace_table(first.limit(3), name, base)
    assert values(spark.table(name).orderBy("n")) == old
    assert len(list(Path(base).iterdir())) == 1

    # The table itself may be read by what replaces it; then other columns.
    replace_table(spark.table(name).filter("n > 1"), name, base)
    assert values(spark.table(name).orderBy("n")) == old[2:]
    assert replace_table(first.select("x"), name, base, "parquet")[0] == 5
    assert spark.table(name).columns == ["x"] and spark.table(name).count() == 5
    assert len(list(Path(base).iterdir())) == 1
    replace_table(first.limit(0), name, base)
    assert spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_unstable_rows_are_compared_as_written(spark, tmp_path):
    random = spark.range(1000).select(F.rand().alias("r"), F.col("id").cast("string").alias("s"))
    assert write_checked(random, str(tmp_path / "r"))[0] == 1000
