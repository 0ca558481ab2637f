"""Runs registered queries against their SQL in DuckDB.

usage: python tests/compare.py <sf dir> [name or prefix ...]
"""

from __future__ import annotations

import decimal
import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, (bool, type(None), str, int)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.9g}")
    return str(value)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)
    return [columns[i] for i in order], lines


def compare(spark, con, sf, name, fn, sql):
    """(same, rows, message)"""
    df = fn(spark, sf)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, len(got[1]), f"no SQL {df.columns}"
    con.execute(sql)
    want = digest([d[0] for d in con.description], con.fetchall())
    if got[0] != want[0]:
        return False, len(got[1]), f"columns {got[0]} / {want[0]}"
    if got[1] != want[1]:
        only_got = sorted(set(got[1]) - set(want[1]))[:3]
        only_want = sorted(set(want[1]) - set(got[1]))[:3]
        return False, len(got[1]), f"rows {len(got[1])}/{len(want[1])}\n   spark: {only_got}\n   duckdb: {only_want}"
    return True, len(got[1]), hashlib.md5("\n".join(got[1]).encode()).hexdigest()[:8]


def main(sf: str, names: list[str]) -> int:
    from segloom.plans import registry
    from segloom.runtime import session

    registry.load()
    spark = session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            same, rows, message = compare(spark, con, sf, name, fn, registry.ORACLE.get(name))
        except Exception as error:  # noqa: BLE001
            same, rows, message = False, -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not same
        print(f"{'ok ' if same else 'BAD'} {name} {rows} {time.time() - start:.1f}s {message if not same or 'no SQL' in message else ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
