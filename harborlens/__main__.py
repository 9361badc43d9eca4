"""Command line: list, run or explain a catalog query on a folder of driver tables.

    python -m harborlens list
    python -m harborlens run duplicate_report /root/testdata/sf0.01 [rows]
    python -m harborlens explain cidr_match /root/testdata/sf0.01
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from harborlens.plans.catalog import QUERIES, all_queries

    queries = all_queries()
    if not argv or argv[0] not in ("list", "run", "explain"):
        print(__doc__)
        return 2
    if argv[0] == "list":
        for name, (build, _) in QUERIES.items():
            print(f"{name:24s} {(build.__doc__ or '').strip().splitlines()[0] if build.__doc__ else ''}")
        return 0
    if len(argv) < 2 or argv[1] not in queries:
        print("unknown query; try: python -m harborlens list")
        return 2
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    from harborlens.session import build_session
    spark = build_session()
    df = queries[argv[1]](spark, sf_dir)
    if argv[0] == "explain":
        df.explain("formatted")
    else:
        df.show(int(argv[3]) if len(argv) > 3 else 20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
