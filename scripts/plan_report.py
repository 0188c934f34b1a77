"""Plan shape of every registered query -> PLANS.md (markdown on stdout).

For each key of ``plans.queries.all_queries()`` at ``$PLAN_SF_DIR`` (default
sf0.01) the physical plan Spark chose *before* runtime re-planning is
inspected (AQE and broadcast thresholds as configured in the session): hash
/ range / single-partition exchanges, join strategies, windows, generators,
cartesian products, Python UDFs and the widest Parquet ``ReadSchema``.
Queries that stage an intermediate write it while being built; those plans are
counted too, under "staged": the number of staged tables, their hash exchanges
and their scans of ``lineitem``.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from terrascore import session as S  # noqa: E402

STAGED: list[str] = []
_stage = S.stage_table_counted


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _recorded(df, *args, **kw):
    STAGED.append(_plan(df))
    return _stage(df, *args, **kw)


S.stage_table_counted = _recorded

from terrascore.plans.queries import all_queries  # noqa: E402

PATTERNS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single exch": r"Exchange SinglePartition",
    "reused exch": r"ReusedExchange",
    "bcast": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "window": r"\bWindow\b",
    "generate": r"\bGenerate\b",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
    "python udf": r"BatchEvalPython|ArrowEvalPython|PythonUDF",
}


def describe(plan: str) -> dict[str, object]:
    row: dict[str, object] = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    # output columns of each Parquet scan: "FileScan parquet [a#1,b#2L] ..."
    widths = [len(c.split(",")) if c.strip() else 0
              for c in re.findall(r"FileScan parquet[^\[\n]*\[([^\]]*)\]", plan)]
    row["scans"] = len(widths)
    row["widest scan (cols)"] = max(widths) if widths else 0
    row["staged"] = len(STAGED)
    row["hash exch in staged"] = sum(len(re.findall(PATTERNS["hash exch"], p)) for p in STAGED)
    row["lineitem scans"] = sum(len(re.findall(r"FileScan parquet[^\[\n]*\[l_orderkey", p)) for p in [plan, *STAGED])
    return row


def main() -> None:
    sf_dir = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.01")
    spark = S.build_session("local[8]", shuffle_partitions=16)
    rows = {}
    for name, q in sorted(all_queries().items()):
        STAGED.clear()
        rows[name] = describe(_plan(q(spark, sf_dir)))
    cols = list(next(iter(rows.values())))
    print(f"Physical plans at `{sf_dir}`, `local[8]`, 16 shuffle partitions, AQE on "
          "(initial plan; AQE may still coalesce partitions or turn a sort-merge "
          "join into a broadcast at runtime).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, r in rows.items():
        print(f"| `{name}` | " + " | ".join(str(r[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
