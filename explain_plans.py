"""Summarise the physical plan of every registered query (initial plan,
before AQE re-optimisation) and write PLANS.md.

usage: python explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from lodgeflow.plans.catalog import QUERIES
from lodgeflow.session import build_session

COUNT = {
    "parquet scans": r"^\(\d+\) Scan parquet",
    "shuffles": r"^\(\d+\) Exchange\b",
    "broadcasts": r"^\(\d+\) BroadcastExchange\b",
    "sort-merge joins": r"^\(\d+\) SortMergeJoin\b",
    "broadcast joins": r"^\(\d+\) BroadcastHashJoin\b",
    "windows": r"^\(\d+\) Window\b",
    "cross / nested-loop joins": r"^\(\d+\) (CartesianProduct|BroadcastNestedLoopJoin)\b",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    # broadcasts off: what a large cluster plans
    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = []
    for name, fn in QUERIES.items():
        text = plan_text(fn(spark, sf))
        counts = {k: len(re.findall(p, text, re.M)) for k, p in COUNT.items()}
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        widest = max((len(m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", text)), default=0)
        rows.append((name, counts, pushed, widest))
    head = list(COUNT) + ["scans with pushed filters", "widest scan (columns)"]
    out = ["# Physical plans of the registered queries", "",
           f"Initial plans (before AQE, broadcasts off) at `{sf}`, written by `explain_plans.py`. A query",
           "whose branches share the listings writes them once while it is made; its plan here reads that table.", "",
           "| query | " + " | ".join(head) + " |", "|---" * (len(head) + 1) + "|"]
    for name, c, pushed, widest in rows:
        out.append(f"| {name} | " + " | ".join(str(c[k]) for k in COUNT) + f" | {pushed} | {widest} |")
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
