"""Every registered query against its DuckDB oracle on the sf0.001 tables (the driver's check, smaller)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
KEYS = sorted(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 4)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert srows  # its own test holds it against brute force
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())
