"""Every query of the catalog against its DuckDB statement."""

import math
import os

import duckdb
import pytest

from lodestrata.plans import catalog

SF = "/root/testdata/sf0.001"
BY_BRUTE_FORCE = {"communities"}
"""Queries without a statement: tests/test_operators.py holds them against brute force."""


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else format(value, ".9g")
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query(spark, duck, key):
    df = catalog.queries()[key](spark, SF)
    rows = df.collect()
    if key not in catalog.oracle_sql():
        assert key in BY_BRUTE_FORCE and rows
        return
    found = duck.execute(catalog.oracle_sql()[key])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(tuple(plain(r[names.index(n)]) for n in order) for r in found.fetchall())
    assert sorted(tuple(plain(r[n]) for n in order) for r in rows) == want
