"""Runs registered queries next to their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Spark type name -> DuckDB type name.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sortable(row):
    return [(value is None, str(type(value)), value if value is not None else 0) for value in row]


def differences(result: DataFrame, connection, sql: str) -> list[str]:
    """What differs between a Spark result and the rows of ``sql``; empty if nothing."""
    columns = sorted(result.columns)
    expected = connection.execute(f"SELECT * FROM ({sql}) AS t")
    types = {d[0]: str(d[1]) for d in expected.description}
    if columns != sorted(types):
        return [f"columns {columns} != {sorted(types)}"]
    found = [f"type of {name}: {kind} != {types[name]}" for name, kind in result.dtypes
             if TYPES.get(kind, kind) != types[name]]
    order = [list(types).index(c) for c in columns]
    want = sorted(([row[i] for i in order] for row in expected.fetchall()), key=_sortable)
    got = sorted(([row[c] for c in columns] for row in result.collect()), key=_sortable)
    if len(want) != len(got):
        return found + [f"rows {len(got)} != {len(want)}"]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return found + [f"{len(bad)} rows differ, first {bad[0]}"] if bad else found
