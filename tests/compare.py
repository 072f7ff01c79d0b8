"""Run named queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, connection, plan, sql, sf_dir) -> tuple[bool, str]:
    frame = plan(spark, sf_dir)
    got_columns, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if not sql:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    cursor = connection.execute(sql)
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if wrong:
        return False, f"{len(wrong)} of {len(got)} rows differ: {wrong[:3]}"
    return True, f"{len(got)} rows"


def main() -> int:
    from brightloom.plans.registry import PLANS
    from brightloom.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(PLANS)
    spark = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            ok, note = compare(spark, connection, *PLANS[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {time.time() - started:6.1f}s {note[:2000]}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
