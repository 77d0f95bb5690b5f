"""Crosses of values that are a rounding apart, against the SQL over tables with shifted keys."""

import os

import duckdb
import pytest

from tapeline.plans.queries import ORACLES, QUERIES
from tests.test_queries import SF, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    """Lines with shifted keys, of whose bars one symbol's first ones have k equal to d but for rounding."""
    folder, c = tmp_path_factory.mktemp("shifted"), duckdb.connect()
    c.execute(f"copy (select * replace (l_orderkey + 41 as l_orderkey) from '{SF}/lineitem.parquet') to '{folder}/lineitem.parquet' (format parquet)")
    c.execute(f"create view lineitem as select * from '{folder}/lineitem.parquet'")
    return str(folder), c


@pytest.mark.parametrize("name", ["cross_up_events", "grouped_pattern_results", "topn_signals", "pattern_summary"])
def test_crosses_are_those_of_the_sql(spark, shifted, name):
    folder, c = shifted
    got, want = QUERIES[name](spark, folder).toPandas(), c.execute(ORACLES[name]).fetchdf()
    cols = sorted(want.columns)
    assert rows(got, cols) == rows(want, cols)
