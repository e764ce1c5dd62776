"""Every ledger query against its SQL, at the smallest scale."""

import math
import os

import duckdb
import pytest

from ledgerline.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.9g}" if not isinstance(v, str) else v


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    cursor = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == want
