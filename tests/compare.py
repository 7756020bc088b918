"""Run a query on Spark and its SQL on DuckDB and compare names, types and rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    table = connection.sql(sql).to_arrow_table()
    names = list(spark_df.columns)
    if sorted(names) != sorted(table.column_names):
        return f"columns {sorted(names)} != {sorted(table.column_names)}"
    mine = spark_df.toArrow()
    kinds = {f.name: str(f.type).replace("large_", "") for f in mine.schema}
    theirs = {f.name: str(f.type).replace("large_", "") for f in table.schema}
    if kinds != theirs:
        return f"types {[(k, kinds[k], theirs[k]) for k in kinds if kinds[k] != theirs[k]]}"
    left = _rows(names, zip(*[c.to_pylist() for c in mine.columns]))
    right = _rows(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    if left != right:
        return (
            f"{sum(left.values())} rows, {sum(right.values())} expected; "
            f"extra {list((left - right).items())[:2]}; missing {list((right - left).items())[:2]}"
        )
    return None if left else "no rows"
