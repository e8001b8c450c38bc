"""Every registered library query against its SQL on the smallest tables."""

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

from driftwell import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    if isinstance(v, Decimal):
        return plain(float(v))
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def rows(columns, found):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


def near(x, y):
    """Equal; floating-point numbers nearly so. Integers have no tolerance."""
    return x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float)) and float in (type(x), type(y)) and math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-6))


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    if name not in queries.oracle_sql():
        assert df.columns
        return
    found = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = rows(names, found.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(near(x, y) for x, y in zip(a, b, strict=True)), (a, b)
