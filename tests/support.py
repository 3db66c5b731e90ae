"""DuckDB on the same tables, and rows in a form that both engines share."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def engine(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def spark_rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
