"""The steps as jobs for ``spark-submit``.

    spark-submit visitlog/jobs.py land    --log <uri> --output <uri>
    spark-submit visitlog/jobs.py refine  --log <uri> --table visits_refined
    spark-submit visitlog/jobs.py analyze --table visits_refined --output <uri>
    spark-submit visitlog/jobs.py export  --table visits_refined --output <uri>
    spark-submit visitlog/jobs.py daily   --log <uri> --base <uri> --output <uri>
"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from visitlog.plans.export import export_batches, export_cells  # noqa: E402
from visitlog.plans.incremental import merged_charts, refine_new_files  # noqa: E402
from visitlog.plans.quality import clean_counts  # noqa: E402
from visitlog.plans.refine import refine_to_table  # noqa: E402
from visitlog.plans.report import shared_analysis_results, shared_chart_results  # noqa: E402
from visitlog.schema import REFINED_COLUMNS  # noqa: E402
from visitlog.session import close_run, get_session, release  # noqa: E402
from visitlog.sinks.csvfiles import export_csv  # noqa: E402
from visitlog.sinks.publish import publish_all  # noqa: E402
from visitlog.sources.delimited import read_positional_csv  # noqa: E402
from visitlog.sources.landing import land_csv_if_absent, land_if_absent  # noqa: E402
from visitlog.sources.tables import read_refined  # noqa: E402


def land_job(spark, args):
    if args.rfc4180:
        line_sep = None if args.crlf else "\n"
        landed = land_csv_if_absent(spark, args.log, args.output, line_sep=line_sep)
    else:
        landed = land_if_absent(spark.read.text(args.log), args.output)
    print("landed" if landed else "already there")


def refine_job(spark, args):
    raw = read_positional_csv(spark, args.log, rfc4180=args.rfc4180)
    refine_to_table(raw, args.table, fmt=args.format, compact=args.compact).show(truncate=False)


def analyze_job(spark, args):
    visits = read_refined(spark, args.table)
    with shared_analysis_results(visits, args.clock) as results:
        paths = publish_all(results, args.output)
    if args.charts:
        with shared_chart_results(visits, args.clock) as charts:
            named = {f"chart_{name}": df for name, df in charts.items()}
            paths |= publish_all(named, args.output)
    for name, path in paths.items():
        print(name)
        spark.read.parquet(path).show(truncate=False)


def export_job(spark, args):
    visits = read_refined(spark, args.table)
    clean_counts(visits).show()
    if args.pages:
        order, staged = None if args.stored_order else REFINED_COLUMNS, []
        try:
            export_csv(export_batches(visits, args.clock, order, staged=staged), args.output)
        finally:
            release(spark, staged)
    else:
        export_csv(export_cells(visits, args.clock), args.output)


def daily_job(spark, args):
    """Refine what is new below the log; charts over all days from their partial sums."""
    options = {"fmt": args.format, "clock": args.clock, "rfc4180": args.rfc4180}
    refine_new_files(spark, args.log, args.base, **options).show(truncate=False)
    if args.output:
        charts = merged_charts(spark, args.base, args.clock)
        for name, path in publish_all({f"chart_{n}": df for n, df in charts.items()}, args.output).items():
            print(name)
            spark.read.parquet(path).show(truncate=False)


def parse(argv):
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    steps = parser.add_subparsers(required=True)

    def step(job, **options):
        sub = steps.add_parser(job.__name__.removesuffix("_job"))
        sub.set_defaults(job=job)
        sub.add_argument("--no-hive", dest="hive", action="store_false")
        for name, settings in options.items():
            sub.add_argument(f"--{name}", **settings)

    needed, flag = {"required": True}, {"action": "store_true"}
    clock = {"choices": ["12h", "24h"], "default": "12h"}
    step(land_job, log=needed, output=needed, rfc4180=flag, crlf=flag)
    step(refine_job, log=needed, table=needed, format={"default": "orc"}, compact=flag, rfc4180=flag)
    step(daily_job, log=needed, base=needed, output={}, format={"default": "orc"}, clock=clock, rfc4180=flag)
    step(analyze_job, table=needed, output=needed, clock=clock, charts=flag)
    step(
        export_job, table=needed, output=needed, clock=clock, pages=flag,
        **{"stored-order": flag | {"help": "number pages in stored order: no sort, no shuffle"}},
    )
    return parser.parse_args(argv)


def main(argv=None):
    args = parse(argv)
    spark = get_session(hive=args.hive)
    try:
        args.job(spark, args)
    finally:
        close_run(spark)


if __name__ == "__main__":
    main()
