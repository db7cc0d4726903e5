"""Run registered queries beside their SQL twins: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def cell(value) -> str:
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, name, run, sql):
    started = time.time()
    frame = run(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    seconds = time.time() - started
    con.execute(sql)
    want = rows_of([d[0] for d in con.description], con.fetchall())
    return got, want, seconds


def main() -> int:
    from smeltery import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if name not in oracle or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            got, want, seconds = compare(spark, con, sf_dir, name, run, oracle[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"{name}: ERROR {str(error)[:1500]}", flush=True)
            continue
        same = got == want
        bad += not same
        print(f"{name}: {'ok' if same else 'DIFF'} rows={len(got[1])} {seconds:.2f}s", flush=True)
        if not same:
            print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            only = sorted(set(got[1]) - set(want[1]))[:3], sorted(set(want[1]) - set(got[1]))[:3]
            print("  spark only", only[0], "\n  sql only", only[1])
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
