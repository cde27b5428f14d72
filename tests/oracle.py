"""Side-by-side comparison of a registered query with its DuckDB oracle."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "array<string>": "VARCHAR[]", "array<bigint>": "BIGINT[]", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else 0.0 if v == 0 else v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences in schema, row count and values; empty when equal."""
    res = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in res.description}
    got_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if want_types != got_types:
        problems.append(f"schema: spark {got_types} duckdb {want_types}")
    want = _rows([d[0] for d in res.description], res.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        problems.append(f"rows: spark {len(got)} duckdb {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"values: {len(bad)} differ, e.g. spark {bad[0][0]} duckdb {bad[0][1]}")
    return problems
