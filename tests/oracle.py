"""Run a registered query and its SQL side by side and compare rows."""

from __future__ import annotations

import math

import duckdb

from goldthread.plans.registry import TABLES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_value(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_value(x)}" for k, x in v.items()) + "}"
    if hasattr(v, "asDict"):
        return _value(v.asDict())
    return repr(v)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, marks in {
        "int": ("int",), "float": ("double", "float"), "text": ("string", "varchar"), "bool": ("bool",),
        "time": ("timestamp",), "date": ("date",), "decimal": ("decimal",),
    }.items():
        if not name.startswith(("array", "struct", "map")) and "[]" not in name and any(m in name for m in marks):
            return kind
    return "nested"


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    rel = con.sql(sql)
    names, types = rel.columns, [str(x) for x in rel.types]
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(df.columns)
    spark_types = dict(df.dtypes)
    kinds = [(c, spark_types[c], t) for c, t in zip(names, types) if _kind(spark_types[c]) != _kind(t)]
    if kinds:
        return f"types differ: {kinds}"
    ours = sorted(tuple(_value(r[c]) for c in order) for r in df.select(*order).collect())
    at = [names.index(c) for c in order]
    theirs = sorted(tuple(_value(r[i]) for i in at) for r in rel.fetchall())
    if len(ours) != len(theirs):
        only = [x for x in ours if x not in set(theirs)][:3], [x for x in theirs if x not in set(ours)][:3]
        return f"{len(ours)} rows vs {len(theirs)}; {order}; only ours/theirs: {only}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row differs {order}: {a} vs {b}"
    return None if ours else "no rows on either side"
