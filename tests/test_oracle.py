"""Every registered query against its SQL on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def _key(row):
    return tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLE.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    want = _rows(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert type(a) is type(b), (g, w)
            if isinstance(a, float):
                assert math.isclose(a, b, rel_tol=1e-12), (g, w)
            else:
                assert a == b, (g, w)
