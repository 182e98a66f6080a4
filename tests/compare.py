"""Rows of a query and of its SQL, made comparable."""

import decimal
import os

import duckdb


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return repr(int(v)) if v == int(v) else repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return repr(v) if isinstance(v, float) else str(v)


def assert_same(spark, query, sql: str, folder: str) -> None:
    got = query(spark, folder)
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    want = con.execute(sql)
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(got.columns)
    mine = sorted(tuple(_plain(r[n]) for n in names) for r in got.collect())
    assert mine == sorted(tuple(map(_plain, r)) for r in want.fetchall())
