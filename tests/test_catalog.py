"""Each query against DuckDB on the same tables, where they exist."""

import math
import os

import duckdb
import pytest

from strandframe import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5)
    return x


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, duck, name):
    found = catalog.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    have = [tuple(r) for r in found.select(*columns).collect()]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(map(plain, r)) for r in have), key=key) == sorted((tuple(map(plain, r)) for r in want), key=key)
