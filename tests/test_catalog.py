"""Every query of the catalogue at the smallest scale, against DuckDB where there is SQL."""

import datetime
import decimal
import math

import duckdb
import pytest

from lontar.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got[0]
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert got == table(names, cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
