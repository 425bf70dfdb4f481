"""Summarize the physical plan of every registered query as a markdown table.

usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts, in the initial adaptive plan (before runtime re-planning): shuffle
exchanges, broadcast exchanges, sort-merge and broadcast-hash joins, partial
window group limits, scans and scans with pushed filters.
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.plans.registry import QUERIES  # noqa: E402
from marketlake.session import local_session  # noqa: E402


def summarize(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        - plan.count("ReusedExchange"),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "partial_wgl": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "scans": plan.count("FileScan"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    cols = ["shuffles", "reused", "broadcasts", "smj", "bhj", "cartesian", "partial_wgl", "scans", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in QUERIES.items():
        if name == "bronze_manifest":
            continue
        df = fn(spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        s = summarize(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
