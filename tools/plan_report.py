"""Plan shape of every registered query: shuffles, join kinds, windows,
scans and pushed filters, from the optimized physical plan (before AQE
re-planning). Writes a Markdown table to stdout.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelsmith.plans import registry  # noqa: E402
from panelsmith.session import local_session  # noqa: E402

ML = {
    "rf_cv", "feature_importance", "impute_forest", "impute_panel",
    "rf_cv_audit", "feature_importance_audit", "impute_forest_audit",
}


def shape(plan: str) -> dict:
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "exchanges": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "broadcast_joins": count(r"BroadcastHashJoin|BroadcastNestedLoopJoin"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "windows": count(r"\bWindow \["),
        "aggregates": count(r"(?:Hash|ObjectHash|Sort)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
        "sort_aggregates": count(r"SortAggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
        "sorts": count(r"\bSort \["),
        "scans": count(r"FileScan parquet|Scan parquet"),
        "pushed_filters": count(r"PushedFilters: \[[^\]]+\]"),
        "python_udfs": count(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    registry.load_all()
    cols = ["exchanges", "broadcast_joins", "sort_merge_joins", "windows", "aggregates", "sort_aggregates", "sorts", "scans", "pushed_filters", "python_udfs"]
    print(f"# Plan shapes ({os.path.basename(sf_dir)}, optimized physical plan before AQE)\n")
    print("Queries that materialize shared inputs show the plan that reads the materialized tables.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name in sorted(registry.QUERIES):
        if name in ML:
            continue
        df = registry.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
