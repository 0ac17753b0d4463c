"""Compare a query with its SQL counterpart: column names and types, rows, values."""

from __future__ import annotations

from collections.abc import Mapping

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import oracle_sql
from workload.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE"}


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as a sorted list, columns in name order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str, made: Mapping = None, sql: Mapping = None
) -> str:
    """Run a query and its statement, of this folder unless others are given, and say how they differ."""
    frame = (made or queries())[name](spark, sf_dir)
    relation = con.sql((sql or oracle_sql())[name])
    want_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    got_types = {c: KINDS.get(t, t) for c, t in frame.dtypes}
    if got_types != want_types:
        return f"SCHEMA {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    got = _rows(frame.columns, frame.collect())
    want = _rows(relation.columns, relation.fetchall())
    if got != want:
        diff = [pair for pair in zip(got, want) if pair[0] != pair[1]][:2]
        return f"VALUES got {len(got)} want {len(want)} first {diff}"
    return f"ok {len(got)}"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with every test table as a view."""
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con
