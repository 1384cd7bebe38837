"""Every registered query gives the rows that DuckDB, or a plain-Python answer, gives on the same tables."""

import decimal
import math
import os

import duckdb
import pytest

from foliant import catalog
from foliant.session import TABLES
from tests.plain import PLAIN


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    """Values as both engines write them."""
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else v
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got == sorted(repr([plain(v) for v in r]) for r in PLAIN[name](duck))
        return
    result = duck.sql(sql)
    names = result.columns
    assert sorted(names) == columns
    assert got == sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in result.fetchall())
