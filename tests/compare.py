"""Run registered queries against DuckDB and compare whole results, order aside."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def difference(con, sql: str, df) -> str | None:
    """None if equal, else what differs first."""
    rel = con.sql(sql)
    cols, want = rel.columns, rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(canonical(df.columns, got), canonical(cols, want)):
        if a != b:
            return f"got {a}\nexpected {b}"
    return None
