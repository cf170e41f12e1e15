"""Order-insensitive comparison of a Spark result with the SQL result of DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(None if r[i] is None else str(r[i] + 0.0 if isinstance(r[i], float) else r[i]) for i in order) for r in rows),
        key=repr,
    )


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]).upper() for c in cursor.description}
    expected_columns, expected = _canonical(names, cursor.fetchall())
    columns, actual = _canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        got = kinds[name]
        if same.get(kind, kind) != got:
            out.append(f"type {name}: {kind} vs {got}")
    if len(actual) != len(expected):
        out.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        a, e = set(actual), set(expected)
        out.append(f"only spark: {sorted(a - e, key=repr)[:3]}; only sql: {sorted(e - a, key=repr)[:3]}; {len(a - e)}")
    return out
