"""Every survey query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from fathom.plans.queries import QUERIES, SQL


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for p in Path(tiny).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, tiny, duck, name):
    out = QUERIES[name](spark, tiny)
    columns = sorted(out.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in out.collect()), key=repr)
    answer = duck.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0
