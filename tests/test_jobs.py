from tests.helpers import values
from visitlog import jobs
from visitlog.operators.ranking import top_k_values
from visitlog.plans.refine import refine
from visitlog.plans.report import (
    analysis_results,
    chart_results,
    shared_analysis_results,
    shared_chart_results,
)
from visitlog.schema import export_schema, refined_schema
from visitlog.sinks.csvfiles import export_csv
from visitlog.sources.delimited import read_exported_csv
from visitlog.sources.derived import as_positional, visits_from_events
from visitlog.sources.tables import read_refined


def test_log_to_table_to_analyses_to_csv(spark, tmp_path, capsys):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    export_csv(as_positional(visits_from_events(events)), log, header=False)

    landed = str(tmp_path / "landed")
    for said in ("landed", "already there"):
        jobs.main(["land", "--log", log, "--output", landed, "--no-hive"])
        assert said in capsys.readouterr().out

    jobs.main(["refine", "--log", landed, "--table", "job_visits", "--no-hive"])
    visits = read_refined(spark, "job_visits")
    assert visits.count() == events.filter("event_type = 'purchase'").count()
    assert "filtered_out" in capsys.readouterr().out

    jobs.main(["analyze", "--table", "job_visits", "--output", out, "--charts", "--no-hive"])
    for name, df in analysis_results(visits).items():
        assert values(spark.read.parquet(f"{out}/{name}")) == values(df), name
    for name in chart_results(visits):
        assert spark.read.parquet(f"{out}/chart_{name}").count() > 0

    jobs.main(["export", "--table", "job_visits", "--output", f"{out}/csv", "--no-hive"])
    jobs.main(["export", "--table", "job_visits", "--output", f"{out}/pages", "--pages", "--no-hive"])
    pages = spark.read.option("header", True).csv(f"{out}/pages")
    numbers = sorted(int(r.sheet_row) for r in pages.collect())
    exported = read_exported_csv(spark, f"{out}/csv", export_schema())
    assert exported.count() == visits.dropna().filter(
        "trim(lname) != '' and trim(fname) != '' and trim(time_of_arrival) != ''"
        " and trim(info_comment) != ''"
    ).count()
    assert numbers == list(range(2, exported.count() + 2))
    assert values(top_k_values(exported, "info_comment")) == values(
        spark.read.parquet(f"{out}/chart_top_comments")
    )


def test_daily_job(spark, tmp_path, capsys):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log, base, out = (str(tmp_path / n) for n in ("log", "base", "out"))
    raw = as_positional(visits_from_events(events))
    export_csv(raw, f"{log}/first", header=False)
    for _ in range(2):
        jobs.main(["daily", "--log", log, "--base", base, "--output", out, "--no-hive"])
    assert "new_files" in capsys.readouterr().out
    for name, df in chart_results(refine(raw)).items():
        got = spark.read.parquet(f"{out}/chart_{name}").select(*df.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name


def test_shared_results_equal_the_single_ones(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    some = refine(as_positional(visits_from_events(events)))
    none = spark.createDataFrame([], refined_schema())
    for visits in (some, none):
        for alone, together, arranged in [
            (analysis_results, shared_analysis_results, list),
            (chart_results, shared_chart_results, lambda rows: sorted(rows, key=str)),
        ]:
            single = alone(visits)
            with together(visits) as shared:
                assert shared.keys() == single.keys()
                for name, df in shared.items():
                    assert df.dtypes == single[name].dtypes, name
                    assert arranged(values(df)) == arranged(values(single[name])), name
