"""Compare a query with its SQL, order-insensitively."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"


def connection():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in os.listdir(DATA):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    return c


def value(x):
    if isinstance(x, float):
        return "null" if x != x else repr(round(x, 9))
    return "null" if x is None else str(x)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(r[i]) for i in order) for r in found)


def same(spark, query, sql):
    got = query(spark, DATA)
    want = connection().execute(sql)
    columns = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())
