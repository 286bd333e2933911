"""Small frames for edge cases."""

from visitlog.schema import REFINED_COLUMNS, refined_schema

CLEAN_ROW = ("Doe", "Jane", "10/12/2010 02:05", "10/12/2010 02:00", "WH", "TOUR")


def visits(spark, *changes):
    """One clean row per dict of changes."""
    rows = [
        tuple(change.get(c, v) for c, v in zip(REFINED_COLUMNS, CLEAN_ROW)) for change in changes
    ]
    return spark.createDataFrame(rows, refined_schema())


def one(df):
    """The only row of a frame as a dict."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def values(df):
    return [tuple(r) for r in df.collect()]


def plan_text(df):
    """The physical plan; the final one if the frame has been run."""
    return df._jdf.queryExecution().executedPlan().toString()
