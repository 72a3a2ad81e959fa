"""Compare registered queries with their SQL twins."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _key(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b and type(a) is type(b)


def differences(spark: SparkSession, con, sf_dir: str, run, sql: str) -> list[str]:
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    result = con.execute(sql)
    found = [(d[0], str(d[1])) for d in result.description]
    rows = result.fetchall()
    if sorted(n for n, _ in found) != names:
        return [f"columns {names} against {sorted(n for n, _ in found)}"]
    order = [[n for n, _ in found].index(n) for n in names]
    types = dict(df.dtypes)
    problems = [
        f"type of {n}: {types[n]} against {t}" for n, t in found if KINDS.get(types[n], types[n]) != t
    ]
    theirs = sorted((tuple(r[i] for i in order) for r in rows), key=_key)
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {str(bad[0][0])[:300]} against {str(bad[0][1])[:300]}")
    return problems
