"""Comparison of registered queries with DuckDB, row by row and without regard to order."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return int(v) if v == int(v) else round(float(v), 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    got, want = rows_of(df.columns, [tuple(r) for r in df.collect()]), con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    want = rows_of(names, want.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
    return sum(got.values())
