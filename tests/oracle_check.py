"""Compare registered queries with their DuckDB statements.

Run as a script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from anonkit.sources.tables import TEST_TABLES  # noqa: E402

# Spark type name -> DuckDB type name at the registry boundary
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TEST_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def differences(df, connection, sql: str) -> list[str]:
    """What differs in columns, types, row count and values; empty if nothing does."""
    names = sorted(df.columns)
    expected = connection.execute(sql)
    columns = [c[0] for c in expected.description]
    types = {c[0]: str(c[1]) for c in expected.description}
    if sorted(columns) != names:
        return [f"columns {names} != {sorted(columns)}"]
    found = [
        f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in df.schema.fields
        if TYPES.get(f.dataType.simpleString()) != types[f.name]
    ]
    order = [columns.index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=_sortable)
    left = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_sortable)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if not all(map(_same, a, b))]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0]}")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from anonkit.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        conf={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, connection, sql[name]) if name in sql else [f"no oracle, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found and name in sql)
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if not found else ' | '.join(found)[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
