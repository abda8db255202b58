import glob
import os

import duckdb
import pytest

from moorage.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    assert sorted(map(tuple, got.select(*order).collect()), key=str) == sorted(want.select(", ".join(order)).fetchall(), key=str)
