"""Run a registered query and its DuckDB statement and list the differences."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {
        "int": ("int", "short", "byte", "long", "hugeint"),
        "double": ("double", "float"),
        "decimal": ("decimal",),
        "text": ("string", "varchar"),
        "bool": ("bool",),
        "time": ("timestamp", "date"),
    }.items():
        if any(w in name for w in words):
            return kind
    return name


def _plain(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str, limit: int = 3) -> list[str]:
    """Problems found; empty when names, kinds, row counts and values agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    expected = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns: only spark {set(df.columns) - set(columns)}, only sql {set(columns) - set(df.columns)}"]
    for name, dtype in df.dtypes:
        if _kind(dtype) != kinds[name]:
            problems.append(f"type of {name}: spark {dtype}, sql {kinds[name]}")
    names = sorted(columns)
    places = [columns.index(n) for n in names]

    def key(row):
        return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)

    want = sorted((tuple(_plain(r[p]) for p in places) for r in expected), key=key)
    got = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=key)
    if len(want) != len(got):
        problems.append(f"rows: spark {len(got)}, sql {len(want)}")
    if got != want:
        in_spark, in_sql = set(got), set(want)
        missing = [r for r in got if r not in in_sql]
        absent = [r for r in want if r not in in_spark]
        for a, b in list(zip(missing, absent))[:limit]:
            diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
            problems.append(f"spark vs sql: {diff}")
        if not missing and not absent:
            problems.append("multiplicity differs")
        else:
            problems.append(f"{len(missing)} spark rows not in sql, {len(absent)} sql rows not in spark")
    return problems
