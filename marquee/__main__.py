"""Command line: one Spark application per call.

    python -m marquee backfill  --raw GLOB --store DIR --first YYYY-MM --last YYYY-MM
    python -m marquee run-month --raw GLOB --store DIR --month YYYY-MM
    python -m marquee stream    --source DIR --store DIR [--checkpoint DIR]
    python -m marquee report    --store DIR --name REPORT [--out DIR]
    python -m marquee report    --store DIR --all --out DIR
    python -m marquee export    --store DIR --out DIR
    python -m marquee summary   --store DIR [--rebuild] [--share COUNTRY]
    python -m marquee compact   --store DIR
    python -m marquee prune     --store DIR [--keep N]

Cluster settings (master, executors, spark.checkpoint.dir) come from
spark-submit / spark-defaults; nothing here overrides them.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from marquee.plans import analyses as A
from marquee.plans.analyses import REPORTS
from marquee.plans.jobs import backfill, run_month
from marquee.plans.summary import CatalogSummary
from marquee.session import ensure_checkpoint_dir
from marquee.sources.export import export_for_bi, write_csv
from marquee.sources.raw import read_raw_csv
from marquee.sources.store import CatalogStore
from marquee.streaming import catalog_stream

def _month(s: str) -> tuple[int, int]:
    y, m = s.split("-")
    return int(y), int(m)


def _print(df) -> None:
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in row))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("backfill", "run-month"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True, help="raw catalog CSV path or glob")
        p.add_argument("--store", required=True)
        p.add_argument("--single-line", action="store_true",
                       help="split files; no quoted field may hold a line break")
        p.add_argument("--split", action="store_true", help="split files whose quoted fields may hold line breaks")
        p.add_argument("--replace-null-ids", action="store_true", help="a rerun replaces its rows without an id too")
        if name == "backfill":
            p.add_argument("--first", required=True, type=_month)
            p.add_argument("--last", required=True, type=_month)
        else:
            p.add_argument("--month", required=True, type=_month)
    p = sub.add_parser("stream")
    p.add_argument("--source", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--checkpoint", help="default: in the store, one for each source")
    p = sub.add_parser("compact")
    p.add_argument("--store", required=True)
    p = sub.add_parser("summary", help="take new loads into the kept yearly summary and print it")
    p.add_argument("--store", required=True)
    p.add_argument("--rebuild", action="store_true")
    p.add_argument("--share", metavar="COUNTRY", help="print the yearly share of titles from outside a country instead")
    p = sub.add_parser("report")
    p.add_argument("--store", required=True)
    p.add_argument("--name", choices=sorted(REPORTS))
    p.add_argument("--all", action="store_true", help="every report, one CSV folder each under --out")
    p.add_argument("--out", help="write CSV here instead of printing")
    p = sub.add_parser("prune")
    p.add_argument("--store", required=True)
    p.add_argument("--keep", type=int, default=2)
    p.add_argument("--abandoned-after", type=float, help="seconds after which an unfinished load counts as crashed (default: never)")
    p = sub.add_parser("export")
    p.add_argument("--store", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--require-dir", action="store_true")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(f"marquee-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    store = CatalogStore(spark, args.store)
    if args.cmd in ("backfill", "run-month"):
        raw = read_raw_csv(spark, args.raw, multi_line=not args.single_line, split=args.split)
        if args.cmd == "backfill":
            v = backfill(spark, raw, store, args.first, args.last, args.replace_null_ids)
        else:
            v = run_month(spark, raw, store, *args.month, args.replace_null_ids)
        print(f"published version {v}")
    elif args.cmd == "stream":
        catalog_stream(spark, args.source, store, checkpoint=args.checkpoint).awaitTermination()
        print(f"latest version {store.latest()}")
    elif args.cmd == "summary":
        summary = CatalogSummary(store)
        summary.rebuild() if args.rebuild else summary.refresh()
        _print(summary.share(args.share) if args.share else summary.read())
    elif args.cmd == "report":
        titles, genres = store.read()
        if args.all:
            if not args.out:
                ap.error("--all needs --out")
            for name, fn in REPORTS.items():
                write_csv(fn(titles, genres), f"{args.out.rstrip('/')}/{name}.csv", single_file=True)
            print(f"wrote {len(REPORTS)} reports to {args.out}")
        else:
            if not args.name:
                ap.error("give --name or --all")
            df = REPORTS[args.name](titles, genres)
            if args.out:
                write_csv(df, args.out, single_file=True)
            else:
                _print(df)
    elif args.cmd == "compact":
        print(f"published version {store.compact()}")
    elif args.cmd == "prune":
        print(f"dropped versions {store.prune(args.keep, args.abandoned_after)}")
    elif args.cmd == "export":
        titles, genres = store.read()
        written = export_for_bi(spark, titles, genres, args.out,
                                summary=A.j1_yearly_summary(titles), require_dir=args.require_dir)
        print("\n".join(f"{k}: {v}" for k, v in written.items()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
