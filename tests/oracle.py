"""Compare a DataFrame with DuckDB's answer to SQL, order and column order aside."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.8g}")
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def same(df, con, sql):
    answer = con.sql(sql)
    names = list(answer.columns)
    assert sorted(df.columns) == sorted(names)
    ours = sorted(repr(tuple(plain(row[c]) for c in sorted(names))) for row in df.collect())
    place = [names.index(c) for c in sorted(names)]
    theirs = sorted(repr(tuple(plain(row[i]) for i in place)) for row in answer.fetchall())
    assert ours == theirs
