"""Compare a query with its SQL, as rows in any order."""

import glob
import math
import os

import duckdb


def connect(where):
    con = duckdb.connect()
    for f in glob.glob(f"{where}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return f"{v + 0.0:.6g}" if isinstance(v, float) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def same(df, con, sql):
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
