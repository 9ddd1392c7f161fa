"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import os
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark simple type name -> DuckDB type name of the same values.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_problems(sdf, rel) -> list[str]:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck_types.get(f.name) != want:
            out.append(f"type of {f.name}: spark {want} vs duckdb {duck_types.get(f.name)}")
    return out


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    return (1, repr(v))


def rows(cols, records, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in records)


def compare(sdf, con, sql) -> list[str]:
    """Problems found (empty when the results agree)."""
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols, d_rows = rel.columns, rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"]
    typing = type_problems(sdf, rel)
    if typing:
        return typing
    order = sorted(s_cols)
    a, b = rows(s_cols, s_rows, order), rows(d_cols, d_rows, order)
    if len(a) != len(b):
        return [f"row count {len(a)} vs {len(b)}"]
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return [f"{len(diff)} rows differ, e.g. {diff[:1]}"] if diff else []
