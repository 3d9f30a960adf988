"""Compare every query with its SQL twin: ``python tests/check_oracles.py [folder] [name ..]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalith import workload  # noqa: E402
from catalith.session import build_session  # noqa: E402
from catalith.workload.frames import TABLES  # noqa: E402


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = []
    for r in rows:
        out.append(tuple("" if r[i] is None else f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]) for i in order))
    return sorted(out)


def compare(spark, con, name, folder):
    df = workload.QUERIES[name](spark, folder)
    started = time.time()
    got = canonical(df.collect(), df.columns)
    took = time.time() - started
    if name not in workload.ORACLES:
        return f"rows-only {len(got)}", True, took
    cur = con.execute(workload.ORACLES[name])
    names = [d[0] for d in cur.description]
    want = canonical(cur.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", False, took
    if got != want:
        a, b = set(got), set(want)
        return f"rows {len(got)} vs {len(want)}; only spark {sorted(a - b)[:2]}; only sql {sorted(b - a)[:2]}", False, took
    return f"ok {len(got)}", len(got) > 0, took


def main(argv):
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    workload.load()
    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in argv[1:] or list(workload.QUERIES):
        try:
            message, fine, took = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001
            message, fine, took = f"{type(e).__name__}: {str(e)[:1200]}", False, 0.0
        bad += not fine
        print(f"{'PASS' if fine else 'FAIL'} {name} {took:.1f}s {message}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
