"""Run catalogue queries from the command line.

usage:
  python -m branchlens.plans.run --list
  python -m branchlens.plans.run branch_kpis --sf-dir /root/testdata/sf0.01 --show 20
  python -m branchlens.plans.run top_products --sf-dir <dir> --out <shared folder>/top_products
  python -m branchlens.plans.run product_totals --sf-dir <dir> --explain
"""

from __future__ import annotations

import argparse
import sys

from branchlens.plans.catalog import QUERIES


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="branchlens.plans.run")
    ap.add_argument("query", nargs="?")
    ap.add_argument("--list", action="store_true", help="list the query names")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", help="write the result as parquet to this folder")
    ap.add_argument("--show", type=int, default=0, help="print the first N rows")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if a.list or not a.query:
        print("\n".join(QUERIES))
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query!r}; use --list", file=sys.stderr)
        return 2
    from branchlens.session import build_session
    spark = build_session(a.master)
    df = QUERIES[a.query](spark, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show:
        df.show(a.show, truncate=False)
    if not (a.out or a.show or a.explain):
        df.write.format("noop").mode("overwrite").save()
    return 0


if __name__ == "__main__":
    sys.exit(main())
