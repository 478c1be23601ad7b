"""Comparison of Spark results with SQL results."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sortable(row):
    return tuple(("", "") if v is None else (type(v).__name__, "nan" if isinstance(v, float) and math.isnan(v) else v) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=_sortable)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    result = con.execute(sql)
    return normal([d[0] for d in result.description], result.fetchall())
