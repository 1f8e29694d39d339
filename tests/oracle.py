"""Compares a query with its SQL in DuckDB over the same tables."""

import datetime
import decimal
import glob
import os

import duckdb

SF = "/root/testdata/sf0.01"


def connect(folder=SF):
    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def assert_same(spark, query, sql, folder=SF):
    df, found = query(spark, folder), connect(folder).sql(sql)
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    at = [found.columns.index(n) for n in names]
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert got == want
