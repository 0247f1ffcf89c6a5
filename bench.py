"""Benchmark: run the headline queries and print one JSON line.

Each query is built and executed to completion through the ``noop`` sink
(every row computed, nothing collected). Environment:
``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_QUERIES`` (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "fct_cost",              # build + write the gold fact (dedupe, two validity joins, pricing)
    "fct_cost_inline",       # the same fact as one lazy plan
    "daily_energy",          # daily roll-up of the gold fact
    "cost_by_tariff_band",
    "latest_version",        # newest version per key
    "range_join_broadcast",  # 600k line items x order windows (sf0.1), checked broadcast
    "range_join_bucketed",   # the same, shuffle path on (customer, month)
    "asof_windows",          # the same, as-of by running last()
    "missing_intervals",     # series + anti join
    "missing_by_gap",        # gaps between neighbours
    "overlapping_windows",
    "upsert_one_key",        # 4 audited loads into day partitions
    "incremental_lookback",  # full load, lookback run, re-run
    "stream_latest",         # file stream -> foreachBatch upsert, replayed
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from wattline.registry import QUERIES
    from wattline.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="wattline-bench", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM once (class loading, JIT, codegen caches) outside the timings:
    # the flagship on the smallest dataset.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if Path(warm_dir).exists():
        QUERIES["fct_cost_inline"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
        except Exception as exc:  # keep the JSON line; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            continue
        times[name] = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_ROWS"):
        for name in times:
            rows[name] = QUERIES[name](spark, sf_dir).count()

    sf = Path(sf_dir).name.replace("sf", "")
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "spark": spark.version}
    if rows:
        out["rows"] = rows
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
