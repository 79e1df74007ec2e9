"""Spark results against DuckDB on the smallest test tables."""

import os

import pandas as pd

SF = "/root/testdata/sf0.001"


def connection():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def shown(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
        return "NULL"
    if isinstance(x, float):
        return f"{x:.9g}"
    return str(list(x)) if hasattr(x, "tolist") and not isinstance(x, str) and getattr(x, "ndim", 0) else str(x)


def normal(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(shown, r)) for r in df.itertuples(index=False))


def compare(spark, con, query, sql):
    got = normal(query(spark, SF).toPandas())
    want = normal(con.execute(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
