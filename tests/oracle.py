"""Run a query in Spark and its SQL in DuckDB over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if v == v else None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


def rows_of(columns, rows, order):
    at = [columns.index(c) for c in order]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def both(con, df, sql):
    order = sorted(df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == order
    return rows_of(df.columns, df.collect(), order), rows_of(names, cursor.fetchall(), order)
