"""Every registered query runs, and equals its SQL in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from tessera.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(str([plain(x) for x in r]) for r in df.select(*cols).collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got or name == "q_near_dup_answers"  # the smallest tables may have no near copies
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted(str([plain(r[i]) for i in order]) for r in found.fetchall())


def test_entry_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
