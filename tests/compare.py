"""Compare a query with its SQL in DuckDB, by column name and as multisets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = sorted(spark_df.columns)
    got = Counter(tuple(row) for row in spark_df.select(*names).collect())
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != names:
        return [f"columns {names} against {sorted(columns)}"]
    order = [columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    if got == want:
        return []
    return [
        f"{sum(got.values())} rows against {sum(want.values())}",
        f"only in Spark: {list((got - want).items())[:3]}",
        f"only in SQL:   {list((want - got).items())[:3]}",
    ]
