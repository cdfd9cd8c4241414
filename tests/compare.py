"""Order-insensitive comparison of a Spark frame with a DuckDB statement."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x) if x != int(x) else int(x)
    if isinstance(x, float):
        return round(x, 8) + 0.0
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return x


def rows(arrow) -> list[tuple]:
    names = sorted(arrow.schema.names)
    cols = [arrow.column(n).to_pylist() for n in names]
    return sorted((tuple(plain(v) for v in r) for r in zip(*cols)), key=repr)


def differences(spark_df, con, statement: str) -> list[str]:
    a = spark_df.toArrow()
    b = con.sql(statement).to_arrow_table()
    if sorted(a.schema.names) != sorted(b.schema.names):
        return [f"columns {sorted(a.schema.names)} against {sorted(b.schema.names)}"]
    x, y = rows(a), rows(b)
    out = []
    if len(x) != len(y):
        out.append(f"rows {len(x)} against {len(y)}")
    if x != y:
        xs, ys = set(x), set(y)
        out += [f"{sorted(a.schema.names)}", f"spark only {len(xs - ys)}: {sorted(xs - ys, key=repr)[:3]}",
                f"duckdb only {len(ys - xs)}: {sorted(ys - xs, key=repr)[:3]}"]
    return out
