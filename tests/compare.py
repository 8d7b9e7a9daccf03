"""Side by side run of a query on Spark and its SQL check."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types or rows; empty when both agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _sorted_rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if same.get(kind, kind) != types[name].split("[")[0]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    different = [(a, b) for a, b in zip(got, expected) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems
