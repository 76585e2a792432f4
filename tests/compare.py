"""Run a query and its SQL counterpart and describe how the results differ."""

from __future__ import annotations

import math

import duckdb

from lettera.plans.catalog import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def _text(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides have the same columns and the same rows, bit for bit."""
    names = sorted(df.columns)
    mine = sorted(tuple(_text(v) for v in r) for r in df.select(*names).collect())
    theirs_types = dict(r[:2] for r in con.execute(f"DESCRIBE {sql}").fetchall())
    cursor = con.execute(sql)
    theirs_names = [c[0] for c in cursor.description]
    if sorted(theirs_names) != names:
        return [f"columns: {names} against {sorted(theirs_names)}"]
    wrong = [
        f"{c}: {t} against {theirs_types[c]}"
        for c, t in df.dtypes if SQL_TYPES[t] != theirs_types[c]
    ]
    if wrong:
        return wrong
    order = [theirs_names.index(n) for n in names]
    theirs = sorted(tuple(_text(r[i]) for i in order) for r in cursor.fetchall())
    if mine == theirs:
        return []
    only_mine = sorted(set(mine) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(mine))[:3]
    return [
        f"rows: {len(mine)} against {len(theirs)}", str(names),
        *[f"+ {r}" for r in only_mine], *[f"- {r}" for r in only_theirs],
    ]
