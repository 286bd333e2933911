from pathlib import Path

import pytest
from pyspark.sql import types as T

from tests.helpers import one, values
from visitlog.operators.reshape import stringify_cells
from visitlog.plans.refine import refine, refine_counts, refine_log, refine_to_table
from visitlog.schema import (
    RAW_WIDTH,
    REFINED_COLUMNS,
    VISITEE_POSITION,
    positional_schema,
    refined_schema,
)
from visitlog import session
from visitlog.operators import paging
from visitlog.session import get_session, new_shared_path, release, shared_folder, stage
from visitlog.sinks.csvfiles import export_csv
from visitlog.sinks.publish import publish_all
from visitlog.sinks.tables import save_refined, verify_written
from visitlog.sources.delimited import read_positional_csv
from visitlog.sources.landing import has_landed, land_csv_if_absent, land_if_absent
from visitlog.sources.tables import read_refined


def _log(spark, visitees, width=RAW_WIDTH):
    rows = [
        tuple(v if i == VISITEE_POSITION else f"{i}:{n}" for i in range(width))
        for n, v in enumerate(visitees)
    ]
    return spark.createDataFrame(rows, positional_schema(width))


VISITEES = ["POTUS", "potus", " POTUS", None, "", "POTUS", "OTHER"]


def test_refine_keeps_one_visitee_and_names_positions(spark):
    df = refine(_log(spark, VISITEES))
    assert df.columns == list(REFINED_COLUMNS)
    assert values(df) == [
        tuple(f"{i}:{n}" for i in (0, 1, 6, 11, 21, 25)) for n in (0, 5)
    ]
    assert values(refine_log(_log(spark, VISITEES, 30))) == values(df)
    assert refine(_log(spark, VISITEES), "OTHER").count() == 1


def test_counts(spark):
    assert one(refine_counts(_log(spark, VISITEES))) == {
        "raw_rows": 7, "kept_rows": 2, "filtered_out": 5,
    }
    assert one(refine_counts(_log(spark, []))) == {
        "raw_rows": 0, "kept_rows": 0, "filtered_out": 0,
    }


@pytest.mark.parametrize("compact", [False, True])
@pytest.mark.parametrize("fmt", ["orc", "parquet"])
@pytest.mark.parametrize("visitees", [VISITEES, ["x"], []])
def test_refine_to_table(spark, visitees, fmt, compact):
    log = _log(spark, visitees)
    kept = sum(v == "POTUS" for v in visitees)
    counts = one(refine_to_table(log, "visits_refined", fmt=fmt, compact=compact))
    assert counts == {
        "raw_rows": len(visitees),
        "kept_rows": kept,
        "filtered_out": len(visitees) - kept,
        "written_rows": kept,
        "complete": True,
    }
    stored = read_refined(spark, "visits_refined")
    assert stored.schema == refined_schema()
    assert sorted(values(stored)) == sorted(values(refine(log)))
    provider = spark.sql("DESCRIBE EXTENDED visits_refined").filter("col_name = 'Provider'").first()
    assert provider.data_type.lower() == fmt


def test_a_log_file_end_to_end(spark, tmp_path):
    lines = [",".join(str(i) if i != VISITEE_POSITION else v for i in range(28))
             for v in ("POTUS", "VPOTUS", "POTUS")]
    path = tmp_path / "log.txt"
    path.write_text("\n".join([*lines, "too,short"]) + "\n")
    counts = one(refine_to_table(read_positional_csv(spark, str(path)), "visits_refined"))
    assert (counts["raw_rows"], counts["kept_rows"], counts["complete"]) == (4, 2, True)
    assert values(read_refined(spark, "visits_refined")) == [("0", "1", "6", "11", "21", "25")] * 2


def test_saving_replaces_and_is_verified(spark):
    rows = refine(_log(spark, VISITEES))
    for df, expected in [(rows, 2), (rows.limit(1), 1)]:
        save_refined(df, "visits_refined")
        check = one(verify_written(spark, "visits_refined", expected, refined_schema()))
        assert check == {
            "written_rows": expected, "expected_rows": expected,
            "rows_match": True, "schema_matches": True,
        }
    wrong = T.StructType(refined_schema().fields[:5])
    check = one(verify_written(spark, "visits_refined", 5, wrong))
    assert not check["rows_match"] and not check["schema_matches"]


def test_landing_happens_once(spark, tmp_path):
    source, target = tmp_path / "log.txt", str(tmp_path / "landed")
    source.write_text('a,"b" \n\nc\n')
    assert land_if_absent(spark.read.text(str(source)), target)
    assert not land_if_absent(spark.createDataFrame([("other",)], "value string"), target)
    assert [r.value for r in spark.read.text(target).collect()] == ['a,"b" ', "", "c"]


def test_landing_sees_files_and_replaces_interrupted_writes(spark, tmp_path):
    single = tmp_path / "visits.txt"
    assert not has_landed(spark, str(single))
    single.write_text("x\n")
    assert has_landed(spark, str(single))

    uploaded = tmp_path / "uploaded"
    uploaded.mkdir()
    assert not has_landed(spark, str(uploaded))
    (uploaded / "visits.txt").write_text("x\n")
    assert has_landed(spark, str(uploaded))

    broken = tmp_path / "broken"
    (broken / "_temporary").mkdir(parents=True)
    (broken / "part-00000").write_text("half\n")
    assert not has_landed(spark, str(broken))
    assert land_if_absent(spark.createDataFrame([("whole",)], "value string"), str(broken))
    assert [r.value for r in spark.read.text(str(broken)).collect()] == ["whole"]


def test_publish_writes_one_output_per_result(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "n int")
    publish_all({"a": a, "b": a}, str(tmp_path))
    paths = publish_all({"a": a.union(a), "b": stringify_cells(a)}, f"{tmp_path}/")
    assert paths == {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"}
    assert spark.read.parquet(paths["a"]).count() == 2
    assert values(spark.read.parquet(paths["b"])) == [("1",)]


def test_stage_uses_the_shared_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")
    staged = stage(spark.range(3), "unit")
    assert sorted(r.id for r in staged.collect()) == [0, 1, 2]
    assert all(f"{folder}/visitlog-run-" in f and "/unit-" in f for f in staged.inputFiles())


def test_release_deletes_by_path(spark):
    paths = []
    stage(spark.range(3), "one", paths)
    stage(spark.range(3), "two", paths)
    folders = [Path(p) for p in paths]
    assert all(f.exists() for f in folders)
    release(spark, paths)
    assert not any(f.exists() for f in folders) and not paths


def test_numbering_leaves_nothing_behind_when_it_fails(spark, monkeypatch):
    made = []

    def failing(df, label, staged=None):
        if label == "offsets":
            raise RuntimeError("on purpose")
        out = stage(df, label, staged)
        made.append(Path(staged[-1]))
        return out

    monkeypatch.setattr(paging, "stage", failing)
    with pytest.raises(RuntimeError):
        paging.number_rows(spark.range(10), ["id"])
    assert len(made) == 2 and not any(p.exists() for p in made)


class Elsewhere:
    """A session on a cluster, whose executors see the driver's files or don't."""

    def __init__(self, spark, seen):
        self.spark, self.seen = spark, seen
        self.sparkContext = spark.sparkContext
        self.conf = self

    def get(self, key, default=None):
        settings = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": "file:///tmp/own"}
        return settings.get(key, default)


@pytest.mark.parametrize("seen", [True, False])
def test_a_local_folder_on_a_cluster_must_be_shared(spark, monkeypatch, seen):
    monkeypatch.setattr(session, "_seen_by_executors", lambda spark, folder: seen)
    if seen:
        assert shared_folder(Elsewhere(spark, seen)) == "file:///tmp/own"
    else:
        with pytest.raises(ValueError):
            shared_folder(Elsewhere(spark, seen))


def test_executors_are_asked_whether_they_see_a_folder(spark, tmp_path):
    assert session._seen_by_executors(spark, str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def test_a_quoted_file_lands_whole_whatever_the_splits(spark, tmp_path):
    cells = [(f"r{i}", "a,b\nc" if i % 2 else "x\ry \"q\"", "z\r\n" * (i % 3) + "e") for i in range(300)]
    source, landed = str(tmp_path / "raw"), str(tmp_path / "landed")
    export_csv(spark.createDataFrame(cells, "a string, b string, c string").repartition(7), source, header=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert land_csv_if_absent(spark, source, landed)
        assert not land_csv_if_absent(spark, source, landed)
        assert sorted(values(read_positional_csv(spark, landed, 3, rfc4180=True, line_sep="\n"))) == sorted(cells)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_compact_reads_the_log_once(spark, tmp_path):
    """Each row of the log passes a counter, which only successful tasks add to, once."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    log = _log(spark, VISITEES * 20)
    counted = log.mapInArrow(count, log.schema)
    assert one(refine_to_table(counted, "visits_refined", compact=True))["complete"]
    assert read.value == 140


def test_session_factory_returns_the_running_session(spark):
    found = get_session("another name", hive=False)
    assert found.sparkContext is spark.sparkContext
