"""Compare a registered query with its SQL, as sorted rows by column name."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [
        tuple(round(r[i], 6) if isinstance(r[i], float) and math.isfinite(r[i]) else r[i] for i in order)
        for r in rows
    ]
    return [columns[i] for i in order], sorted(clean, key=repr)


def expected(con, sql):
    got = con.execute(sql)
    return _rows([d[0] for d in got.description], got.fetchall())


def actual(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])
