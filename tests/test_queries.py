"""Every core query runs; those with SQL give the same rows in both engines."""

import glob
import os

import duckdb
import pytest

from codexmill.plans import registry


def canonical(frame):
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or v != v:
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in frame.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, data, duck, name):
    got = registry.queries()[name](spark, data).toPandas()
    sql = registry.oracles().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
