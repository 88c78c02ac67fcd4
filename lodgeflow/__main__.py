"""Command line: the pipeline run that replaces the original task DAG.

    python -m lodgeflow pipeline --src RAW_DIR --dst WAREHOUSE_DIR [--catalog] [--single-line] [--lenient]
                                 [--staged-listing STAGING_TABLE_DIR]
    python -m lodgeflow refresh  --src LISTING_DIR --dst STAGING_TABLE_DIR [--max-files N] [--full]
"""

from __future__ import annotations

import argparse

from .plans.pipeline import run_pipeline
from .session import build_session
from .streaming.refresh import refresh_listing_staging


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lodgeflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="raw CSV -> staging -> datawarehouse -> datamart")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.add_argument("--catalog", action="store_true", help="register <layer>.<table> in the catalog")
    p.add_argument("--single-line", action="store_true",
                   help="no quoted field holds a newline: large files may be split")
    p.add_argument("--lenient", action="store_true",
                   help="unreadable values become NULL and are counted in staging_rejects")
    p.add_argument("--staged-listing", default=None,
                   help="listing staging table kept current by `refresh` (skips re-parsing CSVs)")
    r = sub.add_parser("refresh", help="stage newly arrived monthly listing files")
    r.add_argument("--src", required=True)
    r.add_argument("--dst", required=True)
    r.add_argument("--checkpoint", default=None, help="default: <dst>_checkpoint")
    r.add_argument("--full", action="store_true", help="stage all files anew")
    r.add_argument("--max-files", type=int, default=None)
    for q in (p, r):
        q.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.cmd == "pipeline":
        tables = run_pipeline(spark, args.src, args.dst, multiline=not args.single_line, lenient=args.lenient,
                              catalog=args.catalog, staged_listing=args.staged_listing)
        print("wrote", ", ".join(sorted(tables)))
    else:
        n = refresh_listing_staging(spark, args.src, args.dst, args.checkpoint, args.max_files, full=args.full)
        print("micro-batches:", n)


if __name__ == "__main__":
    main()
