"""Run registered queries on Spark and their oracle SQL on DuckDB; compare rows.

usage: python check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from eventflow.plans import ORACLE, QUERIES
from eventflow.session import local_session
from eventflow.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def compare(spark, sf_dir: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    ts = time.time() - t0
    if name not in ORACLE:
        return True, f"{name}: spark rows={len(srows)} ({ts:.1f}s), no oracle"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    ocols = rel.columns
    if sorted(ocols) != cols:
        return False, f"{name}: columns differ spark={cols} oracle={sorted(ocols)}"
    orows = [tuple(_norm(r[ocols.index(c)]) for c in cols) for r in rel.fetchall()]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    ss, os_ = sorted(srows, key=key), sorted(orows, key=key)
    if ss == os_:
        return True, f"{name}: OK rows={len(ss)} ({ts:.1f}s)"
    diff = [(a, b) for a, b in zip(ss, os_) if a != b][:3]
    return False, f"{name}: MISMATCH spark={len(ss)} oracle={len(os_)} first diffs={diff}"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session(8)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(msg, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
