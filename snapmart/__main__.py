"""Command line for schedulers: ``python -m snapmart load ...`` / ``python -m snapmart build ...``.

Run through spark-submit (or any launcher that provides the session configuration); the session is
taken with ``getOrCreate`` and never reconfigured here.

    python -m snapmart load --landing ROOT --raw ROOT --feed standings --run-date 2024-08-02
    python -m snapmart build --raw ROOT --marts ROOT [--report-only] [--checks-first]
    python -m snapmart stream --landing ROOT --raw ROOT --feed players --checkpoint DIR
    python -m snapmart days --raw ROOT --feed players --first 2024-08-01 --last 2024-08-31
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from snapmart.plans import jobs


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="snapmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="extract-load one run of one feed into its RAW table")
    ld.add_argument("--landing", required=True)
    ld.add_argument("--raw", required=True)
    ld.add_argument("--feed", required=True, choices=sorted(jobs.FEEDS))
    ld.add_argument("--run-date", required=True, type=dt.date.fromisoformat)
    ld.add_argument("--leagues", type=lambda s: [int(x) for x in s.split(",")], default=None)
    ld.add_argument("--season", type=int, default=None)
    ld.add_argument("--whole-files", action="store_true", help="a document is a file, not a line")
    ld.add_argument("--errors", default=None, help="root of the error tables: refused documents go there, others load")
    bd = sub.add_parser("build", help="gate, staging, marts and column checks")
    bd.add_argument("--raw", required=True)
    bd.add_argument("--marts", required=True)
    bd.add_argument("--report-only", action="store_true", help="print failing checks without failing the build")
    bd.add_argument("--fail-on-check", action="store_true", help="the default; kept for old schedules")
    bd.add_argument("--checks-first", action="store_true")
    bd.add_argument("--quarantine", action="store_true", help="store the failing rows of the staging models")
    sm = sub.add_parser("stream", help="ingest newly landed documents of one feed (availableNow)")
    sm.add_argument("--landing", required=True)
    sm.add_argument("--raw", required=True)
    sm.add_argument("--feed", required=True, choices=sorted(jobs.FEEDS))
    sm.add_argument("--checkpoint", required=True)
    sm.add_argument("--max-files-per-trigger", type=int, default=None)
    sm.add_argument("--max-bytes-per-trigger", type=int, default=None, help="bytes of documents in a micro-batch")
    sm.add_argument("--landing-ids", action="store_true", help="landings have ids (a landing= directory)")
    sm.add_argument("--whole-files", action="store_true", help="a document is a file, not a line")
    sm.add_argument("--archive-dir", default=None)
    sm.add_argument("--leagues", type=lambda s: [int(x) for x in s.split(",")], default=None)
    sm.add_argument("--season", type=int, default=None)
    dy = sub.add_parser("days", help="days of a period that a feed never loaded, or loaded more than once")
    dy.add_argument("--raw", required=True)
    dy.add_argument("--feed", required=True, choices=sorted(jobs.FEEDS))
    dy.add_argument("--first", required=True, type=dt.date.fromisoformat)
    dy.add_argument("--last", required=True, type=dt.date.fromisoformat)
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"snapmart-{args.cmd}").getOrCreate()
    if args.cmd == "load":
        kw = {}
        if args.leagues is not None:
            kw["leagues"] = args.leagues
        if args.season is not None:
            kw["season"] = args.season
        n = jobs.load_feed(spark, args.landing, args.raw, args.feed, args.run_date, _now(),
                           whole_files=args.whole_files, errors_root=args.errors, **kw)
        print(json.dumps({"feed": args.feed, "run_date": str(args.run_date), "partitions_rewritten": n}))
        return 0
    if args.cmd == "stream":
        from snapmart.streaming.ingest import stream_upsert
        spec, flatten, _ = jobs.FEEDS[args.feed]
        kw = {k: v for k, v in (("leagues", args.leagues), ("season", args.season)) if v is not None}
        n = stream_upsert(spark, args.landing, args.feed, f"{args.raw}/{spec.name}", spec, flatten, args.checkpoint,
                          max_files_per_trigger=args.max_files_per_trigger,
                          max_bytes_per_trigger=args.max_bytes_per_trigger, archive_dir=args.archive_dir,
                          landing_ids=args.landing_ids, whole_files=args.whole_files,
                          select=lambda docs: jobs.selected(docs, **kw))
        print(json.dumps({"feed": args.feed, "batches_applied": n}))
        return 0
    if args.cmd == "days":
        rows = jobs.load_report(spark, args.raw, args.feed, args.first, args.last).orderBy("day").collect()
        print(json.dumps({"feed": args.feed, "days": [{**r.asDict(), "day": str(r["day"])} for r in rows]}))
        return 1 if any(r["finding"] == "missing" for r in rows) else 0
    out = jobs.build(spark, args.raw, args.marts, _now(), fail_on_check=args.checks_first,
                     checks_first=args.checks_first, quarantine=args.quarantine)
    report = [r.asDict() for r in out["check_report"].collect()]  # 13 rows
    print(json.dumps({"checks": report}))
    return 0 if args.report_only or all(r["passed"] for r in report) else 1


if __name__ == "__main__":
    sys.exit(main())
