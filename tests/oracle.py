"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.10g}") + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def connect(sf: str):
    con = duckdb.connect()
    for p in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, con, fn, sql, sf):
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf)
    c1, r1 = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if r1 else "no rows", len(r1)
    cur = con.execute(sql)
    c2, r2 = rows_of([d[0] for d in cur.description], cur.fetchall())
    if c1 != c2:
        return f"columns {c1} / {c2}", len(r1)
    if len(r1) != len(r2):
        return f"rows {len(r1)} / {len(r2)}", len(r1)
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    if bad:
        return f"{len(bad)} of {len(r1)} rows differ, first {bad[0][0]} / {bad[0][1]} cols {c1}", len(r1)
    return None, len(r1)


def main(argv):
    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    from catalog import load_all
    from tidewheel import get_spark
    queries, oracle = load_all()
    names = [q for q in queries if not argv or any(a in q for a in argv)]
    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                           "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for n in names:
        t = time.time()
        try:
            print(f"...  {n}", flush=True)
            msg, rows = compare(spark, con, queries[n], oracle.get(n), sf)
        except Exception as e:  # report and go on with the next query
            msg, rows = f"{type(e).__name__}: {str(e)[:1500]}", -1
        failed += msg is not None
        print(f"{'FAIL' if msg else 'ok  '} {n} rows={rows} {time.time() - t:.1f}s "
              f"{'' if n in oracle else '(rows only) '}{msg or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
