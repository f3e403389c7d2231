"""Run registered cases next to their SQL and compare: ``check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from lumbre.session import build_session
from lumbre.workloads import CASES, ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def canonical(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, name):
    begin = time.time()
    df = CASES[name](spark, folder)
    mine = rows_of(df.columns, df.collect())
    took = time.time() - begin
    if name not in ORACLES:
        return "rows", f"{len(mine[1])} rows", took
    cur = con.execute(ORACLES[name])
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return "FAIL", f"columns {mine[0]} != {theirs[0]}", took
    if mine[1] != theirs[1]:
        only = [r for r in mine[1] if r not in set(theirs[1])][:2]
        other = [r for r in theirs[1] if r not in set(mine[1])][:2]
        return "FAIL", f"{len(mine[1])} vs {len(theirs[1])} rows; spark {only}; sql {other}", took
    return "ok", f"{len(mine[1])} rows", took


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(CASES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        try:
            state, note, took = compare(spark, con, folder, name)
        except Exception as err:  # report and go on with the next case
            state, note, took = "FAIL", f"{type(err).__name__}: {str(err)[:600]}", 0.0
        bad += state == "FAIL"
        print(f"{state:5} {took:6.2f}s {name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(main())
