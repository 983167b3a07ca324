"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: scans with their read schema and pushed filters, number of
shuffle exchanges, join strategies, window / group-limit / Python operators.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.plans.catalog import REGISTRY  # noqa: E402
from tidepool.session import local_session  # noqa: E402

OPS = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
       "Window", "WindowGroupLimit", "Expand", "Generate", "MapInPandas", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate"]


def summarise(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    counts = {op: len(re.findall(rf"[+\- ]{op} \(\d+\)", tree)) for op in OPS}
    counts["Exchange"] = len(re.findall(r"[+\- ]Exchange \(\d+\)", tree))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\n]*)\]", plan) if p]
    return {"ops": {k: v for k, v in counts.items() if v}, "schemas": schemas, "pushed": pushed}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (local[8], AQE on; final AQE plans may swap a")
    print("sort-merge join for a broadcast join when runtime sizes allow). `Exchange` counts shuffles")
    print("(hash, range, round-robin or single-partition); `spread` round-robin exchanges appear only")
    print("when a scan is narrower than the cluster and vanish on large inputs.\n")
    print("| query | shuffles | operators | scans: read schema | pushed filters |")
    print("|---|---|---|---|---|")
    for name, q in REGISTRY.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.run(spark, sf).explain("formatted")
        plan = buf.getvalue()
        s = summarise(plan)
        ops = ", ".join(f"{k}×{v}" for k, v in s["ops"].items() if k != "Exchange")
        schemas = "<br>".join(f"`{x}`" for x in s["schemas"])
        pushed = "<br>".join(f"`{x}`" for x in s["pushed"]) or "—"
        print(f"| `{name}` | {s['ops'].get('Exchange', 0)} | {ops} | {schemas} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
