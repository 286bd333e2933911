"""Registered queries against their SQL."""

from pathlib import Path

import duckdb
import pytest

from visitlog.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    want = sorted(found.fetchall(), key=str)
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == want


@pytest.mark.parametrize("block_windows", [200_000, 1])
def test_items_without_an_id_match_sql(spark, block_windows, monkeypatch):
    import pandas as pd

    from visitlog.llm import decontaminate

    find = decontaminate.find_benchmark
    monkeypatch.setattr(decontaminate, "find_benchmark", lambda d, b: find(d, b, block_windows=block_windows))
    docs = [(1, "one two three"), (2, "four five"), (3, "two three four five"), (4, "none of them")]
    items = [(None, "two three"), (None, "four five"), (7, "three four")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    found = con.execute(ORACLE["op8_decontamination"])
    columns = [d[0] for d in found.description]
    df = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(found.fetchall())
