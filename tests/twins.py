"""Compares a Spark result with DuckDB's result for its SQL twin."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    return v


def rows(table) -> list:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return sorted((tuple(_plain(v) for v in r) for r in zip(*data, strict=True)), key=repr)


def differ(spark_df, con, sql: str) -> str:
    """'' where both results are alike, else what differs."""
    mine, twin = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(mine.column_names) != sorted(twin.column_names):
        return f"columns {mine.column_names} {twin.column_names}"
    kinds = {c: (str(mine.schema.field(c).type).replace("large_", ""), str(twin.schema.field(c).type).replace("large_", "")) for c in mine.column_names}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and "list" not in k[0]}
    if odd:
        return f"types {odd}"
    a, b = rows(mine), rows(twin)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
        return f"{len(a)} rows against {len(b)}, {len(bad)} differ: {bad[:2]}"
    return ""
