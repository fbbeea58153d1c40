"""Summarise the final (adaptive) physical plans of the headline queries.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is executed once (results are discarded) so the report shows the
plan AQE actually chose: scans with their read columns and pushed filters,
joins with their strategy, shuffles, per-task top-k cuts and aggregates.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = [
    "prepare", "sentiment_trends", "competitive_analysis", "success_prediction", "velocity_analysis",
    "theme_prep", "sample_reviews", "text_stats", "completeness", "extract_sample", "top_per_category",
    "last_turns", "feedback_for_top_rated",
]


def final_section(plan: str) -> str:
    """The part of an adaptive plan AQE settled on (drops the initial plan)."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1]
    return plan.split("== Initial Plan ==", 1)[0]


def summarise(plan: str) -> list[str]:
    out = []
    for line in final_section(plan).splitlines():
        s = line.lstrip(" +-:").strip()
        s = re.sub(r"#\d+L?", "", s)
        s = re.sub(r"^\*\(\d+\)\s*", "", s)  # whole-stage codegen marker
        if s.startswith(("FileScan", "Scan parquet")):
            table = re.search(r"/([a-z]+)\.parquet", s)
            schema = re.search(r"ReadSchema: (struct<.*>)", s)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            out.append(f"scan {table.group(1) if table else '?'} {schema.group(1) if schema else ''} pushed={pushed.group(1) if pushed else '[]'}")
        elif re.match(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", s):
            out.append("join " + s[:140])
        elif s.startswith(("Exchange", "BroadcastExchange")):
            out.append(s.split(", [plan_id")[0][:120])
        elif s.startswith("WindowGroupLimit"):
            out.append(s[:120])
        elif s.startswith("AQEShuffleRead"):
            out.append(s[:80])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from revscope.plans.registry import queries
    from revscope.session import session

    spark = session("plan-report", {"spark.sql.shuffle.partitions": "16", "spark.sql.maxMetadataStringLength": "2000"}, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    print(f"# Final physical plans ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`; each query was executed before its plan was read.\n")
    for name in QUERIES:
        df = registry[name](spark, sf)
        df._jdf.queryExecution().toRdd().count()  # runs this frame's own adaptive plan; rows stay on the executors
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(summarise(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
