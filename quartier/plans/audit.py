"""Physical-plan audit of the registered queries (scale red flags).

    python -m quartier.plans.audit [--sf DIR] [name ...]

For each query: number of shuffles, broadcasts, scans with pushed filters,
and red flags that do not survive a large cluster: cartesian / nested-loop
joins, Python UDF evaluation, global single-partition exchanges in the main
plan, windows without a partition key, sort-based aggregates.
"""

from __future__ import annotations

import argparse
import re
import sys

RED_FLAGS = {
    "CartesianProduct": "cartesian product",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "pandas UDF",
    "SortAggregate": "sort-based aggregate",
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main_plan(text: str) -> str:
    """The plan tree without the subtrees of scalar subqueries (a global
    min/max there ends in a one-row single-partition exchange, which is fine)."""
    out, skip_col = [], None
    for line in text.splitlines():
        m = re.search(r"[+:]- ", line)
        col = m.start() if m else len(line) - len(line.lstrip(" :|"))
        if skip_col is not None:
            if col >= skip_col:
                continue
            skip_col = None
        if re.search(r"(?<!Reused)Subquery (scalar-)?subquery#\d+", line) and m \
                and line[m.end():].startswith("Subquery"):
            skip_col = m.start() + 1
            continue
        out.append(line)
    return "\n".join(out)


def audit(df) -> dict:
    body = main_plan(plan_text(df))
    flags = [msg for op, msg in RED_FLAGS.items() if op in body]
    if re.search(r"Exchange SinglePartition", body):
        flags.append("single-partition exchange")
    if re.search(r"Window \[.*\], \[\]", body):
        flags.append("window without partition key")
    aggs = sorted({a for a in ("HashAggregate", "SortAggregate", "ObjectHashAggregate")
                   if re.search(rf"\b{a}\(", body)})
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|"
                                   r"RoundRobinPartitioning|SinglePartition)", body)),
        "broadcasts": body.count("BroadcastExchange"),
        "scans": body.count("FileScan") + body.count("Scan parquet"),
        "aggregates": aggs,
        "window_limit": "WindowGroupLimit" in body,
        "flags": flags,
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--markdown", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from ..session import get_session
    from .catalog import QUERIES, load_all
    load_all()
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.sql.adaptive.enabled": "false"})
    bad = 0
    if a.markdown:
        print("| query | shuffles | broadcasts | aggregates | notes |")
        print("|---|---|---|---|---|")
    for n in a.names or list(QUERIES):
        r = audit(QUERIES[n](spark, a.sf))
        bad += bool(r["flags"])
        if a.markdown:
            notes = ", ".join(r["flags"] + (["WindowGroupLimit"] if r["window_limit"] else []))
            print(f"| `{n}` | {r['shuffles']} | {r['broadcasts']} | "
                  f"{', '.join(r['aggregates']) or '-'} | {notes or '-'} |")
        else:
            print(f"{n:28s} shuffles={r['shuffles']:2d} broadcasts={r['broadcasts']} "
                  f"scans={r['scans']} aggs={r['aggregates']} flags={r['flags']}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
