"""Compare a registered query with its SQL, value by value."""

import datetime as dt
import glob
import os

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def _plain(value):
    return float(value) if isinstance(value, float) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def kind(value):
    for cls in (bool, int, float, str, dt.datetime, dt.date):
        if isinstance(value, cls):
            return cls.__name__
    return type(value).__name__


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())
