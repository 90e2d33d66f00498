"""Spark results against DuckDB results, order-insensitive."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None or value != value:
        return "NULL"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v) for v in r) for r in frame.itertuples(index=False))


def same(spark_df, con, sql):
    a, b = spark_df.toPandas(), con.execute(sql).fetchdf()
    assert sorted(a.columns) == sorted(b.columns)
    left, right = rows(a), rows(b)
    assert len(left) == len(right)
    assert left == right
