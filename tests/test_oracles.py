"""Every registered query of the lake analytics against its SQL in DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from lakegrid.plans import grid_queries, pixel_queries, planning_queries

SF = "/root/testdata/sf0.001"
CASES = [(m, n) for m in (pixel_queries, grid_queries, planning_queries) for n in m.ORACLES]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize(("module", "name"), CASES, ids=[n for _, n in CASES])
def test_query(spark, db, module, name):
    ours = module.QUERIES[name](spark, SF)
    theirs = db.sql(module.ORACLES[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a = sorted(tuple(plain(r[c]) for c in columns) for r in ours.collect())
    place = [theirs.columns.index(c) for c in columns]
    b = sorted(tuple(plain(r[i]) for i in place) for r in theirs.fetchall())
    assert a == b
