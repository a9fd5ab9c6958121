"""Compare queries with their SQL checks.

``python tests/check.py [sf_dir] [query …]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, decimal.Decimal):
        value = float(value)
    return f"{type(value).__name__}:{value!r}"


def rows_of(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(query, df, connection) -> tuple[bool, str]:
    ours = rows_of(df.columns, df.collect())
    if query.sql is None:
        return bool(ours), f"{len(ours)} rows, no SQL"
    cursor = connection.execute(query.sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:3]
        missing = [r for r in theirs if r not in set(ours)][:3]
        return False, f"{len(ours)} vs {len(theirs)} rows; only ours {extra}; only SQL {missing}"
    return True, f"{len(ours)} rows"


def main() -> int:
    from starloom.catalog import ALL
    from starloom.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in args or ALL:
        began = time.time()
        try:
            ok, note = compare(ALL[name], ALL[name].build(spark, sf_dir), connection)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - began:6.2f}s  {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
