"""Compare a Spark query with its DuckDB SQL the way the driver does:
row count, column names (sorted), and an order-insensitive value multiset."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# Spark type name -> DuckDB type name of the same values.
TYPE_PAIRS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_problems(spark_df, rel) -> list:
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, st in s_types.items():
        dt = d_types.get(name)
        if dt is not None and TYPE_PAIRS.get(st) != dt:
            out.append(f"type of {name}: spark={st} duck={dt}")
    return out


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rows_of(d_cols, rel.fetchall())
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
    problems += type_problems(spark_df, rel)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if not problems and s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
