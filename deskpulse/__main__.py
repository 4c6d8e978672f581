"""Command line: list the registered queries, or run one.

    python -m deskpulse list
    python -m deskpulse run frt_chat_flex --inputs /root/testdata/sf0.01 --show 20
    python -m deskpulse run attendance --inputs DIR --out OUT --format csv

``run`` writes the whole result to ``--out`` (parquet by default) when
given, otherwise prints the first ``--show`` rows.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="deskpulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("query")
    run.add_argument("--inputs", required=True, help="folder with the driver's parquet tables")
    run.add_argument("--out", help="write the result here")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    run.add_argument("--show", type=int, default=20)
    run.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)

    from deskpulse.plans.registry import INVENTORY, QUERIES
    if args.cmd == "list":
        for name in QUERIES:
            print(f"{name:30s} {' '.join(INVENTORY.get(name, ()))}")
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; see `python -m deskpulse list`", file=sys.stderr)
        return 2
    from deskpulse.session import build_session
    spark = build_session(args.master, app=f"deskpulse-{args.query}")
    df = QUERIES[args.query](spark, args.inputs)
    if args.out:
        w = df.write.mode("overwrite")
        (w.option("header", "true").csv(args.out) if args.format == "csv" else w.format(args.format).save(args.out))
        print(f"wrote {args.query} to {args.out} ({args.format})")
    else:
        df.show(args.show, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
