"""Run registered queries in Spark and their SQL in DuckDB; compare row counts,
column names and values (rounded, order-insensitive). Local feedback loop only.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tabloom.plans.fixtures import TABLES  # noqa: E402
from tabloom.plans.registry import load_all  # noqa: E402
from tabloom.session import get_spark  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in r))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs = load_all()
    ok = bad = 0
    for name, q in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf).toPandas()
        except Exception:
            print(f"FAIL {name}: spark error\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not q.sql:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            ddf = con.execute(q.sql).fetchdf()
        except Exception as e:
            print(f"FAIL {name}: duckdb error {e}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        kinds = {c: (sdf[c].dtype.kind, ddf[c].dtype.kind) for c in sc if c in ddf.columns}
        kd = {c: k for c, k in kinds.items() if k[0] != k[1]}
        if kd:
            print(f"  note {name}: dtype kinds differ {kd}")
        if sc != dc:
            print(f"FAIL {name}: columns spark={sc} duck={dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(dr)}")
            bad += 1
        elif sr != dr:
            diffs = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: values differ, e.g. {diffs}")
            bad += 1
        else:
            ok += 1
            print(f"OK   {name}: {len(sr)} rows {dt:.1f}s")
    print(f"== {ok} ok, {bad} failed")


if __name__ == "__main__":
    main()
