"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb

TESTDATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(row: dict) -> tuple:
    return tuple((k, round(v, 6) if isinstance(v, float) else v) for k, v in sorted(row.items()))


def sort_key(row: tuple) -> list:
    return [(v is not None, str(v)) for _, v in row]


def rows_of_spark(df) -> list[tuple]:
    return sorted((normal(r.asDict()) for r in df.collect()), key=sort_key)


def rows_of_sql(con, sql: str) -> list[tuple]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted((normal(dict(zip(names, r))) for r in cursor.fetchall()), key=sort_key)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def types_of_spark(df) -> dict:
    return {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}


def types_of_sql(con, sql: str) -> dict:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
