"""Compares registered queries with their SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib

import duckdb

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir: str):
    base = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        base.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return base


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, base, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL's result; empty when there are none."""
    found = base.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        wanted = DUCK_TYPES.get(field.dataType.simpleString())
        if wanted != types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} "
                            f"!= {types[field.name]}")
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(names, found.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if differing:
        a, b = differing[0]
        problems.append(f"{len(differing)} rows differ, first {str(a)[:600]} != {str(b)[:600]}")
    return problems
