"""Every query of the subpackage runs; those with SQL give the same rows in both engines."""

import glob
import os

import duckdb
import pytest

from codexmill.llm import registry


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, data, duck, name):
    got = registry.queries()[name](spark, data).toPandas()
    if name.endswith("_found"):
        assert not got.duplicated().any()
    sql = registry.oracles().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql).df()
    rows = lambda f: sorted(map(str, f[sorted(f.columns)].astype(object).itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


COLUMNS = {
    "p1_found": ["field", "key_a", "key_b"], "p2_found": ["node_id", "markup"], "p3_found": ["field", "name_a", "name_b"], "p4_found": ["node_id", "cut"],
    "p5_found": ["src", "row_key"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "sent_end"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, data, name):
    assert registry.queries()[name](spark, data).columns == COLUMNS[name]
