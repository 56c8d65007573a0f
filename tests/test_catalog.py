"""Every registered query of the catalogue against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from larkspur.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    found = duck.sql(catalog.oracle_sql()[name])
    assert sorted(found.columns) == names
    want = sorted((tuple(r[found.columns.index(c)] for c in names) for r in found.fetchall()), key=str)
    assert len(got) == len(want)
    assert all(same(x, y) for a, b in zip(got, want) for x, y in zip(a, b))
