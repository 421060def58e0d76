"""Command-line entry point for cluster runs (``spark-submit -m`` style).

    spark-submit ... -m freshcat.plans.cli --output s3a://bucket/new_arrivals \\
        --corners corners.json --tables tables.json \\
        [--month 2023-03] [--site SITE --corner CORNER | --all-corners] \\
        [--backfill-from 2022-04 [--until-rows 100] [--skip-months 2022-06,2022-07]] \\
        [--table db.new_arrivals] [--threshold 5]

Without ``--month`` the current month in the catalogue's zone (JST) is used. The two JSON
files hold the corners (:mod:`freshcat.plans.corners`) and the catalogue's tables by role
(:mod:`freshcat.plans.catalogue`). ``--backfill-from`` publishes every month up to
``--month``, of the corner given by ``--site`` and ``--corner`` or of all corners. All ways
publish alike (:func:`freshcat.plans.monthly_job.publish`).
"""

from __future__ import annotations

import argparse
import sys

from freshcat.plans.catalogue import read_role, read_tables
from freshcat.plans.corners import corner_by_name, read_corners
from freshcat.plans.monthly_job import audit_published, run_job
from freshcat.session import checkpoint_dir, get_session


def parse(argv):
    p = argparse.ArgumentParser(prog="freshcat", description="monthly new-arrivals datasets")
    p.add_argument("--output", required=True, help="root of site=/corner=/target_date= partitions")
    p.add_argument("--corners", required=True, help="JSON file of the corners")
    p.add_argument("--tables", help="JSON file of the catalogue's tables by role")
    p.add_argument("--month", help="YYYY-MM (default: current month in JST)")
    p.add_argument("--site")
    p.add_argument("--corner")
    p.add_argument("--all-corners", action="store_true")
    p.add_argument("--backfill-from", help="oldest month YYYY-MM: every month up to --month")
    p.add_argument("--until-rows", type=int, help="with --backfill-from: months newest first per corner until so many rows")
    p.add_argument("--skip-months", default="", help="comma-separated months that count but are not rewritten")
    p.add_argument("--keep-published", action="store_true", help="corner-months published before count but are not rewritten")
    p.add_argument("--audit-from", help="YYYYMMDD: instead of a run, check what is published for --days days")
    p.add_argument("--days", type=int, default=7, help="with --audit-from")
    p.add_argument("--table", help="partitioned table to register new partitions in")
    p.add_argument("--threshold", type=int, default=5)
    args = p.parse_args(argv)
    if bool(args.site) != bool(args.corner):
        p.error("give both --site and --corner")
    if not (args.all_corners or args.backfill_from or args.site or args.audit_from):
        p.error("give --site and --corner, or --all-corners, or --backfill-from, or --audit-from")
    if not (args.tables or args.audit_from):
        p.error("give --tables")
    if args.all_corners and args.site:
        p.error("--all-corners does not go with --site and --corner")
    return args


def main(argv=None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    corners = read_corners(args.corners)
    if args.site:
        corners = (corner_by_name(args.site, args.corner, corners),)
    spark = get_session(app="freshcat-new-arrivals")
    checkpoint_dir(spark)
    if args.audit_from:
        for r in audit_published(spark, args.output, corners, args.audit_from, args.days).orderBy("site", "corner", "target_date").collect():
            print(r.target_date, f"{r.site}_{r.corner}", r.status, r["rows"])
        return 0
    paths = run_job(
        read_tables(spark, args.tables), args.output, corners, args.month, oldest=args.backfill_from, table=args.table,
        threshold=args.threshold, until_rows=args.until_rows, skip_months=[m for m in args.skip_months.split(",") if m],
        keep_published=args.keep_published, bridge_fallback=lambda: read_role(spark, args.tables, "album_collection"),
    )
    for path in paths:
        print(path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
