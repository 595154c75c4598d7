"""Run a query in Spark and its SQL in DuckDB, and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    con.execute(sql)
    return [d[0] for d in con.description], con.fetchall()


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    names, got = spark_rows(df)
    expected_names, expected = duck_rows(con, sql)
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} / {sorted(expected_names)}"
    a, b = rows_of(names, got), rows_of(expected_names, expected)
    if a == b:
        return None
    only_spark, only_sql = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"{sorted(names)}: {len(got)} / {len(expected)} rows; spark {only_spark}; sql {only_sql}"
