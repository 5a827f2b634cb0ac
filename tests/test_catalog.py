"""Every registered query against its oracle on the same tables, and golden rows for what the tables do not show."""

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from ledgerloom.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (int, Decimal)):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(name, spark, duck):
    df = catalog.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    head = [d[0] for d in cur.description]
    assert sorted(head) == names
    at = [head.index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    assert got == want, (list((got - want).items())[:4], list((want - got).items())[:4])
