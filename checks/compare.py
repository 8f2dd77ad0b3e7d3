"""Run registered queries next to their reference SQL and compare all rows.

usage: python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from checks.oracles import ORACLES
from checks.queries import QUERIES
from tickloom.session import build_session


def local_session():
    return build_session(
        "checks", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": "/tmp/tickloom-warehouse",
        },
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in place) for row in rows)


def differences(df: DataFrame, con, sql: str) -> str:
    """`= n rows` when columns and all rows are equal, else a short account."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want, have = _rows(names, found.fetchall()), _rows(df.columns, df.collect())
    if want == have:
        return f"= {sum(want.values())} rows"
    extra, missing = list((have - want).elements()), list((want - have).elements())
    order = sorted(names)
    show = lambda rows: [dict(zip(order, row)) for row in sorted(rows, key=str)[:2]]
    return f"{len(extra)} extra {show(extra)}\n   {len(missing)} missing {show(missing)} of {sum(want.values())}"


def main(sf_dir: str = "/root/testdata/sf0.001", *names: str) -> int:
    spark, con, failed = local_session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        began = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            note = differences(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
            good = note.startswith("= ") or name not in ORACLES
        except Exception as error:  # noqa: BLE001
            note, good = f"{type(error).__name__}: {str(error)[:1500]}", False
        failed += not good
        print("ok  " if good else "FAIL", name, f"{time.monotonic() - began:.1f}s", note, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
