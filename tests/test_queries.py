"""Every query runs on the smallest tables; those with SQL agree with DuckDB."""

import datetime
import decimal
import os

import duckdb
import pytest

from loam.plans import registry

registry.load()
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    if isinstance(v, list | tuple):
        return tuple(norm(x) for x in v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.9g}")
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return float(v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in registry.ORACLE:
        want = duck.sql(registry.ORACLE[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=repr)
