"""Run a registered query by name.

    python -m ledgerlens list
    python -m ledgerlens run mv_query_one_dim --sf-dir /root/testdata/sf0.01 [--show 20] [--explain]
    python -m ledgerlens run agg_daily_store_product --sf-dir DIR --out /shared/results/daily

``--out`` writes the whole result as parquet (nothing passes through the
driver); ``--show`` prints the first rows only.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name")
    run.add_argument("--sf-dir", required=True)
    run.add_argument("--show", type=int, default=20)
    run.add_argument("--out")
    run.add_argument("--explain", action="store_true")
    args = ap.parse_args(argv)

    from .registry import queries
    qs = queries()
    if args.cmd == "list":
        for name in sorted(qs):
            print(name)
        return 0
    if args.name not in qs:
        print(f"unknown query {args.name!r}; see `python -m ledgerlens list`", file=sys.stderr)
        return 2

    from pyspark.sql import SparkSession

    from .session import configure
    spark = configure(SparkSession.builder.appName(f"ledgerlens-{args.name}").getOrCreate())
    df = qs[args.name](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(f"wrote {args.out}")
    else:
        df.show(args.show, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
