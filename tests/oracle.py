"""Run registered queries next to their SQL in DuckDB and compare rows.

    python tests/oracle.py [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {}
    for r in rows:
        for i in order:
            if r[i] is not None:
                kinds.setdefault(names[i], set()).add(kind(r[i]))
    return [names[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr), kinds


def compare(spark_df, con, statement) -> str:
    """Empty string when both sides agree."""
    cur = con.execute(statement)
    dn, drows, dk = rows_of([d[0] for d in cur.description], cur.fetchall())
    big = [d[0] for d in cur.description if "HUGEINT" in str(d[1]) or "DECIMAL" in str(d[1])]
    sn, srows, sk = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if big:
        return f"SQL returns wide types for {big}"
    if sn != dn:
        return f"columns {sn} != {dn}"
    if len(srows) != len(drows):
        return f"rows {len(srows)} != {len(drows)}"
    if sk != dk:
        return f"types {sk} != {dk}"
    if srows != drows:
        bad = [(a, b) for a, b in zip(srows, drows) if a != b]
        return f"{len(bad)} rows differ, e.g. {bad[:2]}"
    return "" if srows else "EMPTY"


def main(args):
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        args = args[:i] + args[i + 2:]
    from socigrain.plans import catalog
    from socigrain.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, build in catalog.QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            df = build(spark, sf)
            if name in catalog.SQL:
                message = compare(df, con, catalog.SQL[name])
            else:
                message = "" if df.count() else "EMPTY"
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {name} {time.time() - t:.1f}s {'' if name in catalog.SQL else '(rows only)'} {message}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
