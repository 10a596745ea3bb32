"""Run a registered query and its SQL twin on the same files and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def sorted_rows(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KIND = {"tinyint": "int", "smallint": "int", "integer": "int", "varchar": "string"}


def kinds(pairs) -> dict[str, str]:
    return {n: _KIND.get(k.lower(), k.lower()) for n, k in pairs}


def differences(df, con, sql: str) -> list[str]:
    """What differs: columns, types or rows. Empty if nothing does."""
    relation = con.sql(sql)
    theirs = kinds(zip(relation.columns, map(str, relation.types)))
    ours = kinds(df.dtypes)
    found = []
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} vs {sorted(theirs)}"]
    if ours != theirs:
        found.append(f"types {[(c, ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]]}")
    a = sorted_rows(df.columns, df.collect())
    b = sorted_rows(relation.columns, con.execute(sql).fetchall())
    if len(a) != len(b):
        found.append(f"rows {len(a)} vs {len(b)}")
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        found.append(f"{len(wrong)} of {len(a)} differ, first {wrong[0]}")
    return found
