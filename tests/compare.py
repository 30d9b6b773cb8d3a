"""Run registered queries next to their SQL and compare every value.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidemark.plans.tables import BASE  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return "decimal", str(v)
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, dt.datetime):
        return "ts", v.isoformat()
    if isinstance(v, dt.date):
        return "date", v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in sorted(v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(norm(row[i]) for i in order) for row in rows), key=repr
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark_df, con, sql: str) -> str:
    """Empty text when equal, else what differs."""
    cols, got = rows_of(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([x[0] for x in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"columns: only spark {sorted(set(cols) - set(want_cols))}, only sql {sorted(set(want_cols) - set(cols))}"
    if len(got) != len(want):
        return f"rows: {len(got)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    if not bad:
        return "" if got else "(empty)"
    a, b = bad[0]
    diff = {c: (x, y) for c, x, y in zip(cols, a, b, strict=True) if x != y}
    return f"{len(bad)} of {len(got)} rows differ, first: {dict(list(diff.items())[:4])}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(args.sf), entry.queries(), entry.oracle_sql()
    fails = 0
    for name, run in queries.items():
        if args.names and name not in args.names:
            continue
        t0 = time.time()
        try:
            if name in sqls:
                out = compare(run(spark, args.sf), con, sqls[name])
            else:
                out = f"(no sql) rows={run(spark, args.sf).count()}"
        except Exception as exc:  # noqa: BLE001
            out = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        fails += bool(out) and not out.startswith("(")
        print(f"{'ok  ' if not out or out.startswith('(') else 'FAIL'} {name} {time.time() - t0:.1f}s {out}", flush=True)
    print("failures:", fails, "| sql without query:", sorted(set(sqls) - set(queries)))


if __name__ == "__main__":
    main()
