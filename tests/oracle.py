"""Running a query on both engines and comparing the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)):
        value = float(value)
        return "nan" if math.isnan(value) else value
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]

    def key(row):
        return tuple(
            (0, "", 0.0) if v is None else (1, "", float(f"{v:.9g}")) if isinstance(v, float) else (2, v, 0.0)
            for v in row
        )

    return [columns[i] for i in order], sorted(plain, key=key)


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    result = con.execute(sql)
    return _table([d[0] for d in result.description], result.fetchall())


def differences(left, right, tolerance: float = 0.0) -> list[str]:
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return [f"columns differ: only left {sorted(set(lc) - set(rc))}, only right {sorted(set(rc) - set(lc))}"]
    if len(lr) != len(rr):
        return [f"row counts differ: {len(lr)} and {len(rr)}"]
    out = []
    for a, b in zip(lr, rr):
        for c, x, y in zip(lc, a, b):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and tolerance:
                if abs(x - y) <= tolerance * max(1.0, abs(x), abs(y)):
                    continue
            out.append(f"{c}: {x!r} != {y!r}")
            if len(out) > 20:
                return out
    return out
