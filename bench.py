"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is materialised with a no-op sink (``write.format("noop")``); the value
is the sum of per-query warm medians. ``BENCH_QUERIES`` (comma list) narrows the
set; ``BENCH_REPEAT`` sets the number of timed runs (default 3, after one warm-up
run that is not timed when BENCH_WARMUP=1).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabloom.plans.registry import load_all  # noqa: E402
from tabloom.session import get_spark  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    warmup = os.environ.get("BENCH_WARMUP", "0") == "1"
    spark = get_spark(f"local[{cpus}]", app="tabloom-bench", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": "16g"})
    qs = load_all()
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = [n for n in qs if not only or n in only]
    times, errors = {}, {}
    for name in names:
        fn = qs[name].fn
        runs = []
        try:
            if warmup:
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # keep going; report the failure
            errors[name] = re.sub(r"\s+", " ", str(e))[:200]
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "sum_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
