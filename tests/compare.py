"""Compare a Spark result with a DuckDB result, whatever the row order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> the DuckDB type that holds the same values.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(spark_df, con, sql: str) -> list[str]:
    found = []
    cursor = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    sql_rows = cursor.fetchall()
    spark_rows = [tuple(r) for r in spark_df.collect()]
    spark_types = {n: TYPES.get(t, t) for n, t in spark_df.dtypes}
    if spark_types != sql_types:
        found.append(f"columns: {sorted(spark_types.items() ^ sql_types.items())}")
        if set(spark_types) != set(sql_types):
            return found
    ours, theirs = _bag(spark_df.columns, spark_rows), _bag(list(sql_types), sql_rows)
    if ours != theirs:
        extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
        found.append(f"rows: {len(spark_rows)} against {len(sql_rows)}")
        found.append(f"only in Spark {len(extra)}: {extra[:2]}")
        found.append(f"only in SQL {len(missing)}: {missing[:2]}")
    return found
