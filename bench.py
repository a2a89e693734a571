"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each timed run builds a new DataFrame (no reuse of finished shuffle stages) and
executes it completely through the ``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwise.session import local_session  # noqa: E402
from cartwise.plans.suite import QUERIES  # noqa: E402

HEADLINE = [
    "dedup_entries", "cart_enriched", "top_products", "top_pairs", "rising_products", "first_month",
    "by_state", "product_month", "daily", "top_carts", "top_carts_lines", "league_points",
    "topk_sum_at_least", "nearest_ancestor", "insert_if_absent", "load_metrics",
    "stream_ingest", "delimited_roundtrip", "table_counts", "lenient_casts",
]


def run_once(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def run_job_once(spark, sf_dir) -> float:
    """All 7 reports + export from the raw tables, cleaning once (the production path)."""
    from cartwise.plans.job import run_job
    from cartwise.session import scratch_path
    from cartwise.sources import driver

    base = scratch_path(spark, "bench-job")
    t = time.perf_counter()
    run_job(spark, None, f"{base}/out", 50, f"{base}/stage", raw_tables=driver.source_tables(spark, sf_dir))
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    for warm in ("top_products", "cart_enriched"):  # warm-up: JIT, file listing, codegen paths
        run_once(spark, QUERIES[warm], sf_dir)
    out = {}
    for name in names:
        out[name] = round(min(run_once(spark, QUERIES[name], sf_dir) for _ in range(repeats)), 3)
    job = None
    if os.environ.get("BENCH_JOB", "1") == "1" and not sys.argv[1:]:
        job = round(run_job_once(spark, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "full_job_sec": job,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
