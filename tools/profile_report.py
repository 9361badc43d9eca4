"""Render a ``BENCH_PROFILE=1 python bench.py`` JSON line as a Markdown table.

    BENCH_PROFILE=1 python bench.py > /tmp/b.json && python tools/profile_report.py /tmp/b.json
"""

from __future__ import annotations

import json
import sys


def main() -> None:
    lines = [ln for ln in open(sys.argv[1]) if ln.startswith("{")]
    d = json.loads(lines[-1])
    prof = d.get("profile", {})
    print(f"## Measured at sf{d['sf']} on local[{d['cpus']}]\n")
    print(f"Total {d['value']} s over {d['n_queries']} queries (each run in full through the noop sink; "
          "streaming entries include staging their input files). From Spark's event log:\n")
    print("| query | seconds | tasks | shuffle write MB | spill MB |")
    print("| --- | --- | --- | --- | --- |")
    for q, t in sorted(d["queries"].items(), key=lambda x: -x[1]):
        p = prof.get(q, {})
        print(f"| {q} | {t} | {p.get('tasks', '-')} | {p.get('shuffle_write_mb', '-')} | {p.get('spill_mb', '-')} |")


if __name__ == "__main__":
    main()
