"""Inspect the executed (adaptive, final) physical plan of every registered
query and write a summary table.

    python tools/plans.py [sf_dir] > PLANS.md

Per query: shuffle exchanges, broadcast exchanges, join strategies, windows,
and flags for what must never appear (cartesian / nested-loop joins, Python
UDFs). Reused exchanges are counted separately: they are shuffles served from
another part of the same plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.plans.registry import QUERIES  # noqa: E402
from marquee.session import local_session  # noqa: E402

PATTERNS = {
    "shuffles": r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "windows": r"\bWindow\b",
    "bad_joins": r"CartesianProduct|BroadcastNestedLoopJoin",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF",
}


SHOWN_PLANS: dict[str, str] = {}


def final_plan(df) -> str:
    """Run the query through its own QueryExecution and return the adaptive
    plan text with every "Initial Plan" block (main and subqueries) removed."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    out, skip_col = [], None
    for line in text.splitlines():
        col = len(line) - len(line.lstrip(" :|+-"))
        if skip_col is not None:
            if col >= skip_col:
                continue
            skip_col = None
        if "== Initial Plan ==" in line:
            skip_col = col
            continue
        out.append(line)
    return "\n".join(out)


SHOWN = ("d3_genre_pairs", "skew_d3_genre_pairs", "j1_yearly_summary", "h3_director_breadth",
         "upsert_titles")
OPERATOR = re.compile(r"(Exchange|Join|Aggregate|Scan|Generate|Window|TakeOrdered|Union|Expand|"
                      r"ReusedExchange|BroadcastExchange|Subquery|Project|Filter)")


def trimmed(plan: str, width: int = 150) -> str:
    """Operator lines of a plan, long expressions cut, adapter projections folded."""
    out = []
    for line in plan.splitlines():
        if "== Final Plan ==" in line or not OPERATOR.search(line):
            continue
        out.append(line[:width] + (" ..." if len(line) > width else ""))
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    rows = []
    for name, fn in QUERIES.items():
        try:
            plan = final_plan(fn(spark, sf))
        except Exception as e:  # noqa: BLE001
            rows.append((name, f"error: {type(e).__name__}"))
            continue
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        rows.append((name, counts))
        if name in SHOWN:
            SHOWN_PLANS[name] = plan
    keys = list(PATTERNS)
    print(f"# Physical plans of the registered queries ({os.path.basename(sf)}, local[8], AQE on, "
          "broadcasts only from measured sizes)\n")
    print("Counts from the final adaptive plan of each query (initial plans stripped). "
          "`shuffles` counts Exchange operators; `bad_joins` (cartesian or "
          "nested-loop) and `python` (Python UDF operators) must be 0.\n")
    print("| query | " + " | ".join(keys) + " |")
    print("|---|" + "---|" * len(keys))
    for name, c in rows:
        if isinstance(c, str):
            print(f"| {name} | {c} |")
        else:
            print(f"| {name} | " + " | ".join(str(c[k]) for k in keys) + " |")
    bad = [n for n, c in rows if not isinstance(c, str) and (c["bad_joins"] or c["python"])]
    print(f"\nQueries with a cartesian / nested-loop join or a Python UDF: {len(bad)}" + (f" ({', '.join(bad)})" if bad else ""))
    for name in SHOWN:
        if name in SHOWN_PLANS:
            print(f"\n## {name}\n\n```\n{trimmed(SHOWN_PLANS[name])}\n```")
    spark.stop()


if __name__ == "__main__":
    main()
