"""Run registered queries against DuckDB on the same Parquet files.

As a script: ``python tests/compare.py SF_DIR [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=repr)


# Type names of either engine under one name.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}


def difference(df, con, sql: str) -> str | None:
    """None when rows, column names and types agree; else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if dict(df.dtypes) != types:
        return f"types: {dict(df.dtypes)} vs {types}"
    if len(actual[1]) != len(expected[1]):
        return f"rows: {len(actual[1])} vs {len(expected[1])}"
    for a, e in zip(actual[1], expected[1]):
        if a != e:
            return f"first difference: {a} vs {e}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from catalograph.session import local_session

    spark = local_session(8)
    con = connect(sys.argv[1])
    names = sys.argv[2:] or list(contract.oracle_sql())
    for name in names:
        t0 = time.time()
        try:
            found = difference(contract.queries()[name](spark, sys.argv[1]), con, contract.oracle_sql()[name])
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:26s} {time.time() - t0:6.2f}s  {found or 'ok'}", flush=True)
