"""Compare a Spark result with its DuckDB twin, as sorted rows of columns sorted by name."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "null" if value is None else f"{type(value).__name__ if isinstance(value, bool) else ''}{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = run(spark, sf_dir)
    names, rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    expected_names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if rows == expected:
        return None if rows else "both empty"
    only = [r for r in rows if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(rows)][:3]
    return f"{len(rows)} rows != {len(expected)}; only in Spark {only}; only in SQL {missing}"
