"""Write PLANS.md: the executed physical plan shape of every registered query.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.1)
Runs each query once (noop sink) and summarises its final adaptive plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwise.plans.suite import QUERIES  # noqa: E402
from cartwise.session import local_session  # noqa: E402

OPS = ("ShuffleQueryStage", "BroadcastQueryStage", "Exchange", "ReusedExchange", "SortMergeJoin",
       "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate", "SortAggregate", "WindowGroupLimit", "Window",
       "TakeOrderedAndProject", "Expand", "Generate", "AQEShuffleRead")


def summarize(plan: str) -> tuple[str, list[str]]:
    plan = plan.split("== Initial Plan ==")[0]  # the final adaptive plan only
    counts: dict[str, int] = {}
    for line in plan.splitlines():
        m = re.match(r"[\s:+\-*()0-9]*([A-Za-z]+)", line)
        if m and m.group(1) in OPS:
            counts[m.group(1)] = counts.get(m.group(1), 0) + 1
    joins = [j for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[[^\]]*\], \[[^\]]*\], (\w+)", plan)]
    scans = []
    for cols, pushed in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan):
        cols = ", ".join(re.sub(r"#\d+L?", "", c) for c in cols.split(","))
        pushed = re.sub(r"#\d+L?", "", pushed)
        scans.append(f"`{cols.strip()}`" + (f" pushed: `{pushed[:90]}`" if pushed else ""))
    ops = ", ".join(f"{k}×{v}" for k, v in sorted(counts.items()))
    if joins:
        ops += "; joins: " + ", ".join(f"{a} {b}" for a, b in joins)
    return ops, scans


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    out = ["# PLANS", "", f"Executed (final adaptive) physical plans of the registered queries at `{sf_dir}`, "
           "local[8], 8 shuffle partitions. Generated by `tools/plan_report.py`.", "",
           "| Query | Operators | Scans (read columns, pushed filters) |", "| --- | --- | --- |"]
    for name, fn in QUERIES.items():
        if name in ("stream_ingest", "delimited_roundtrip", "ragged_rows", "source_files", "report_files"):  # they write files
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops, scans = summarize(plan)
        out.append(f"| {name} | {ops} | {'<br>'.join(scans)} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
