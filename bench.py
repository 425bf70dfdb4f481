"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed with the `noop` sink (full computation, no collect),
once to warm up and then $BENCH_REPEAT times; the median is reported.  A full
layered build (write every table, read it back, run all checks) is timed once.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans.build import run_pipeline  # noqa: E402
from marketlake.plans.registry import QUERIES  # noqa: E402
from marketlake.session import checkpoint_dir, local_session  # noqa: E402
from marketlake.sources.testdata import bronze_from_testdata  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")

    results: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        try:
            _run(fn(spark, sf_dir))  # warm-up (JIT, file listing, codegen cache)
            times = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                _run(fn(spark, sf_dir))
                times.append(time.perf_counter() - t0)
            results[name] = round(statistics.median(times), 3)
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the others
            results[name] = None
            print(f"# {name}: FAILED {str(exc).splitlines()[0][:300]}", file=sys.stderr, flush=True)
            continue
        print(f"# {name}: {results[name]}s", file=sys.stderr, flush=True)

    if not only or "full_build" in only:
        out = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-bench-{uuid.uuid4().hex}"
        try:
            t0 = time.perf_counter()
            run_pipeline(spark, bronze_from_testdata(spark, sf_dir), out, checks=True, gate=False)
            results["full_build"] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001
            results["full_build"] = None
            print(f"# full_build: FAILED {str(exc).splitlines()[0][:300]}", file=sys.stderr, flush=True)
        print(f"# full_build: {results['full_build']}s", file=sys.stderr, flush=True)

    per_query = {k: v for k, v in results.items() if k != "full_build" and v is not None}
    print(json.dumps({
        "metric": "sum_sec_per_query_median",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "failed": sorted(k for k, v in results.items() if v is None),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
