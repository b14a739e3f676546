"""Compare a Spark result with the SQL of its query, as sorted rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    left = rows_of(spark_df.columns, spark_df.collect())
    rel = con.execute(sql)
    columns = [x[0] for x in rel.description]
    right = rows_of(columns, rel.fetchall())
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(columns)}"
    if left == right:
        return None if left else "EMPTY"
    only_left = [x for x in left if x not in set(right)][:3]
    only_right = [x for x in right if x not in set(left)][:3]
    return f"rows {len(left)} / {len(right)}; spark {only_left}; sql {only_right}"
