"""Runs registered queries next to their SQL and compares the answers."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if value is None:
        return "<null>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "<nan>" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def compare(spark, db, folder, name, queries, oracles):
    """A list of differences, empty when the answers are the same."""
    df = queries[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if name not in oracles:
        return [] if rows else ["no rows"]
    result = db.execute(oracles[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(set(columns) ^ set(df.columns))}"]
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[column]:
            problems.append(f"type of {column}: {kind} and {kinds[column]}")
    mine, theirs = normal(df.columns, rows), normal(columns, expected)
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows, expected {len(theirs)}")
    elif mine != theirs:
        off = [(a, b) for a, b in zip(mine, theirs) if a != b]
        problems.append(f"{len(off)} of {len(mine)} rows differ, columns {sorted(columns)}, first: {off[0]}")
    return problems
