"""Benchmark: build the warehouse from the test tables (always a fresh
build), then run every registered query, each timed to completion on a no-op
sink (full execution, no transfer to the driver). The training-data queries are
timed too where their subpackage is there; ``value`` leaves them out, as before.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    import uuid

    from encore.plans.catalog import QUERIES
    from encore.session import build_session, path_join, shared_dir
    from encore.sources.warehouse import build_warehouse, sources_from_tables

    spark = build_session(f"local[{cpus}]", app_name="encore-bench",
                          shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    # always a fresh build (never a warehouse completed by an earlier run)
    t0 = time.perf_counter()
    root = path_join(shared_dir(spark), "encore-bench", uuid.uuid4().hex[:12])
    wh = build_warehouse(spark, sources_from_tables(spark, sf_dir), root)
    times["build_warehouse"] = round(time.perf_counter() - t0, 3)

    for key, fn in QUERIES.items():
        if wanted and key not in wanted:
            continue
        t = time.perf_counter()
        fn(wh).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t, 3)

    llm_times: dict[str, float] = {}
    try:
        from encore.llm.queries import QUERIES as LLM_QUERIES
    except ImportError:
        LLM_QUERIES = {}
    for key, fn in LLM_QUERIES.items():
        if wanted and key not in wanted:
            continue
        t = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        llm_times[key] = round(time.perf_counter() - t, 3)

    query_total = round(sum(v for k, v in times.items() if k != "build_warehouse"), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "build_plus_all_queries",
        "value": round(times["build_warehouse"] + query_total, 3),
        "unit": "sec",
        "queries": {**times, **llm_times},
        "sf": float(m.group(1)) if m else sf_dir,
        "build_sec": times["build_warehouse"],
        "queries_sec": query_total,
        "llm_queries_sec": round(sum(llm_times.values()), 3),
        "n_queries": len(times) - 1,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
