"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, float) and v == 0:
            v = 0.0
        return str(v)

    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    table = df.toArrow()
    return canonical(df.columns, list(zip(*(c.to_pylist() for c in table.columns))))


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())
