"""Run every catalog query and flag executed plan shapes that do not scale.

    python tools/plan_audit.py [sf_dir] > PLANS.md

Flags: nested-loop or cartesian joins, Python evaluation in the plan, any
exchange to a single partition.  Counts shuffles, broadcasts, scans and windows
over every plan that a query executes, not only its last one.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BAD = {
    "nested loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow",
    "single partition": r"Exchange SinglePartition|SinglePartition,",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def walk(node: dict):
    yield node
    for child in node["children"]:
        yield from walk(child)


def executed_plans(folder: str) -> list[tuple[float, dict]]:
    """(start in ms, last plan) of every SQL execution in Spark's event log: with
    adaptive execution the last plan is the one that ran."""
    plans: dict[int, list] = {}
    for d, _, names in os.walk(folder):
        for name in names:
            with open(os.path.join(d, name), errors="replace") as fh:
                for line in fh:
                    if "sparkPlanInfo" in line:
                        e = json.loads(line)
                        if "time" in e:
                            plans[e["executionId"]] = [e["time"], e["sparkPlanInfo"]]
                        elif e["executionId"] in plans:
                            plans[e["executionId"]][1] = e["sparkPlanInfo"]
    return [tuple(p) for p in plans.values()]


def audit(name: str, plans: list[dict]) -> dict:
    """Counts over all plans that a query ran: staging, micro-batches, sinks and the read-back."""
    nodes = [n for p in plans for n in walk(p)]
    names = [n["nodeName"].split(" (")[0].strip() for n in nodes]
    text = "\n".join(n["nodeName"] + " " + n["simpleString"] for n in nodes)
    return {"query": name, "plans": len(plans), "shuffles": names.count("Exchange"), "reused": names.count("ReusedExchange"),
            "broadcasts": names.count("BroadcastExchange"), "scans": sum(n.startswith("Scan") for n in names),
            "windows": names.count("Window"),
            "joins": ", ".join(sorted({n for n in names if re.search("Join", n)})),
            "flags": [k for k, p in BAD.items() if re.search(p, text)]}


def main() -> None:
    from harborlens.plans.catalog import all_queries
    from harborlens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    logs = tempfile.mkdtemp(prefix="harborlens-plans-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs, "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"})
    spans = []
    for name, fn in all_queries().items():
        begin = time.time()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        spans.append((name, begin * 1000 - 1, time.time() * 1000))
    spark.stop()
    plans = executed_plans(logs)
    rows = [audit(name, [p for t, p in plans if a <= t <= b]) for name, a, b in spans]
    print("# Plan audit\n")
    print(f"Generated by `tools/plan_audit.py` on `{sf}` from Spark's event log: every plan that a query executed, as adaptive "
          "execution finally ran it, with staging, micro-batches and sink writes included.\n")
    print("| query | plans run | shuffles | reused | broadcasts | scans | windows | joins | flags |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for r in rows:
        print(f"| {r['query']} | {r['plans']} | {r['shuffles']} | {r['reused']} | {r['broadcasts']} | {r['scans']} | {r['windows']} | "
              f"{r['joins']} | {', '.join(r['flags']) or '-'} |")
    flagged = [r["query"] for r in rows if r["flags"]]
    print(f"\nFlagged: {', '.join(flagged) if flagged else 'none'}.")
    print("\n`single partition` is an exchange to one task. The flagged queries use it for a global aggregate that shapes their "
          "plan (first and last event time, prefix lengths, touched buckets): it receives one partial row from each task.")


if __name__ == "__main__":
    main()
