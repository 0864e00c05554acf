"""Compare a Spark result with the rows DuckDB gives for the oracle's SQL."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
