"""Print compact physical-plan outlines of registered queries.

Usage: python tools/explain_plans.py [sf_dir] [key ...] > PLANS.md
Each plan line is cut to 160 characters (the parse expressions are long).
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADLINE = ["gold_summary", "gold_top_endpoints", "gold_error_analysis", "client_errors_all_weekdays",
            "windowed_traffic", "detect_format"]


def outline(df, width: int = 160) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line if len(line) <= width else line[: width - 3] + "..." for line in plan.splitlines())


def main() -> None:
    from logbeam.operators import gold, heavy, questions
    from logbeam.plans import catalog
    from logbeam.session import local_session, temporary_path
    from logbeam.sources import files

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or HEADLINE
    spark = local_session(8)
    qs = catalog.queries()
    print("# Physical plans (outline)\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf}`: the physical plan before adaptive execution")
    print("re-plans it at run time; expressions cut to 160 characters.")
    print("The registered queries start at the `events` scan and its rendering as log lines; the operators on")
    print("stored Silver, as a user runs them, start at its Parquet scan (second part).\n")
    for key in keys:
        df = qs[key](spark, sf)
        print(f"## `{key}`\n\n```\n{outline(df)}\n```\n")
    if sys.argv[2:]:
        return
    path = temporary_path(spark, "plans")
    files.write_silver(catalog.silver(spark, sf), path)
    stored = files.read_silver(spark, path)

    def heavy_top_ips(silver):
        return heavy.top(silver, "ip", gold.TOP_N, [])

    for op in (gold.summary, gold.top_endpoints, gold.error_analysis, questions.top_endpoints_excluding_files, heavy_top_ips):
        print(f"## `{op.__name__}` on stored Silver\n\n```\n{outline(op(stored))}\n```\n")


if __name__ == "__main__":
    main()
