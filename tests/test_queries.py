"""Every query that has SQL against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pytest

from tapeline.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def rows(df, cols):
    text = lambda v: "" if v is None or v != v else repr(float(v) + 0.0) if isinstance(v, (float, np.floating)) else str(v).replace(" 00:00:00", "")
    return sorted(tuple(map(text, r)) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query(spark, db, name):
    got, want = QUERIES[name](spark, SF).toPandas(), db.execute(ORACLES[name]).fetchdf()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert rows(got, cols) == rows(want, cols)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
