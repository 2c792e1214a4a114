"""Command line for the job chain (each step is one Spark application run).

    python -m marquee ingest  --inbox DIR --raw DIR [--archive DIR]
    python -m marquee queue   --raw DIR --docs DIR --log DIR --as-of YYYY-MM-DD [--limit N]
    python -m marquee build   --raw DIR --docs DIR --out DIR --as-of YYYY-MM-DD [--no-gate]

Folders may be any Hadoop-compatible URI; the stream checkpoint of
``ingest`` lives next to the raw table.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans import warehouse as W
from .session import build_session


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--inbox", required=True)
    a.add_argument("--raw", required=True)
    a.add_argument("--archive")
    q = sub.add_parser("queue")
    q.add_argument("--raw", required=True)
    q.add_argument("--docs", required=True)
    q.add_argument("--log", required=True)
    q.add_argument("--as-of", required=True)
    q.add_argument("--limit", type=int, default=25)
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--docs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--no-gate", action="store_true")
    args = ap.parse_args(argv)

    spark = spark or build_session()
    if args.cmd == "ingest":
        n = W.ingest_revenues(spark, args.inbox, args.raw, args.raw.rstrip("/") + "_checkpoint",
                              args.archive)
        print(json.dumps({"batches": n}))
    elif args.cmd == "queue":
        log = spark.read.parquet(args.log)
        for r in W.enrichment_queue(spark, args.raw, args.docs, log, args.as_of, args.limit).collect():
            print(json.dumps({"title": r.title, "release_year": r.release_year,
                              "lifetime_rev": None if r.lifetime_rev is None else str(r.lifetime_rev)}))
    else:
        try:
            out = W.build(spark, args.raw, args.docs, args.out, args.as_of, gate=not args.no_gate)
        except RuntimeError as ex:
            print(str(ex), file=sys.stderr)
            return 1
        for r in out["checks"].collect():
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
