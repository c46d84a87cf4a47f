"""Command line: python -m roadpulse <ingest|refine|catalog|report> ...

  ingest   five concurrent streams: topic -> decode -> watermark -> raw Parquet
  refine   raw -> refined for every feed (dedup, rules, date partitions); status table
  catalog  database + five external partitioned tables + partition repair
  report   a named analytic over the catalog tables or the refined folders, written as Parquet
           (or shown)

It runs where it is submitted: master and settings are those of the submission. `catalog` and
`report --db` meet in the session's catalog, so across processes that must be a persistent one
(a metastore); `report --refined` needs none.
"""

from __future__ import annotations

import argparse
import json

from roadpulse.schemas import FEEDS


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="roadpulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--base", required=True, help="raw layer root (raw/<feed>, _checkpoints/...)")
    a.add_argument("--landing", help="landing folder root for file topics")
    a.add_argument("--fmt", default="parquet", choices=["kafka", "parquet", "json", "text"])
    a.add_argument("--option", action="append", default=[], help="source option key=value (e.g. kafka.bootstrap.servers=...)")
    a.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    a.add_argument("--watermark", default="2 minutes")
    a.add_argument("--dead-letters", action="store_true", help="route undecodable records to <base>/dead_letters")
    a.add_argument("--late-rows", action="store_true", help="route rows behind the watermark to <base>/late")
    a.add_argument("--keep-going", action="store_true", help="one feed failing leaves the others running")
    a.add_argument("--status", help="folder of a table with every feed's batches, lag, late rows and failures")
    r = sub.add_parser("refine")
    r.add_argument("--raw", required=True)
    r.add_argument("--refined", required=True)
    r.add_argument("--strict", action="store_true")
    r.add_argument("--filter-first", action="store_true")
    r.add_argument("--layout", default="rebalance", choices=["rebalance", "range", "local"])
    r.add_argument("--dynamic", action="store_true", help="replace only the dates present in the raw input, which must hold them whole")
    r.add_argument("--delta", action="store_true", help="the raw input is a delta: new, late and corrected rows of a refined table")
    r.add_argument("--db", help="with --delta: database whose tables get the touched dates")
    c = sub.add_parser("catalog")
    c.add_argument("--db", required=True)
    c.add_argument("--refined", required=True)
    c.add_argument("--location")
    q = sub.add_parser("report")
    from roadpulse.reports import REPORTS
    q.add_argument("name", choices=sorted(REPORTS), metavar="name", help="one of: " + ", ".join(sorted(REPORTS)))
    q.add_argument("--db", help="database of the session's catalog")
    q.add_argument("--refined", help="refined layer root, instead of --db")
    q.add_argument("--dates", help="comma-separated partition dates to read (pruned scan)")
    q.add_argument("--out", help="write the result as Parquet here; otherwise show it")
    q.add_argument("--latest", type=int, help="compute over the newest N rows of each input (dashboard scope)")
    q.add_argument("--as-of", help="date of the active_incidents report (default: today)")
    q.add_argument("--n", type=int, help="rows of a top-n report")
    q.add_argument("--show", type=int, default=50, help="rows to show without --out (default 50)")
    args = ap.parse_args(argv)
    if args.cmd == "report" and bool(args.db) == bool(args.refined):
        ap.error("report needs either --db or --refined")

    spark = _session()

    if args.cmd == "ingest":
        from roadpulse.streaming.ingest import run_ingest
        from roadpulse.streaming.status import StreamStatus
        options = dict(kv.split("=", 1) for kv in args.option)
        trigger = {"availableNow": True} if args.available_now else None
        run_ingest(spark, args.landing, args.base, FEEDS, fmt=args.fmt, trigger=trigger, watermark=args.watermark,
                   dead_letters=args.dead_letters, late_rows=args.late_rows, keep_going=args.keep_going,
                   status=StreamStatus(spark, args.status) if args.status else None, options=options)
    elif args.cmd == "refine":
        from roadpulse.sources.storage import refine_all, refine_deltas
        status = refine_deltas(spark, args.raw, args.refined, db=args.db, strict=args.strict, layout=args.layout) if args.delta else refine_all(spark, args.raw, args.refined, strict=args.strict, layout=args.layout,
                            dynamic=args.dynamic, filter_first=args.filter_first)
        print(json.dumps([r.asDict() for r in status.collect()]))
    elif args.cmd == "catalog":
        from roadpulse.sources import catalog as C
        C.ensure_database(spark, args.db, args.location)
        status = [r.asDict() for r in C.register_and_repair(spark, args.db, args.refined).collect()]
        print(json.dumps(status))
        if any(s["status"] != "created" for s in status):
            raise SystemExit(1)
    elif args.cmd == "report":
        from roadpulse.reports import REPORTS, run_report
        from roadpulse.sources.catalog import newest_rows, scan
        from roadpulse.sources.storage import read_refined
        dates = args.dates.split(",") if args.dates else None
        if args.db and not spark.catalog.databaseExists(args.db):
            raise SystemExit(f"no database {args.db!r} in this session's catalog ({spark.conf.get('spark.sql.catalogImplementation')}): "
                             "configure a persistent catalog for both commands, or give --refined")

        def table(feed):
            if args.db and args.latest and not dates:
                return newest_rows(spark, args.db, feed, args.latest)  # the newest dates alone are read
            if args.db:
                return scan(spark, args.db, feed, dates)
            df = read_refined(spark, feed, args.refined)
            return df.filter(df["date"].isin(dates)) if dates else df

        asked = {k: v for k, v in (("as_of", args.as_of), ("n", args.n)) if v is not None}
        df = run_report(args.name, {f: table(f) for f in REPORTS[args.name][0]}, latest=args.latest, **asked)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
            rows = df.count()
            if rows > args.show:
                print(f"{rows - args.show} more rows of {rows}; --out writes all, --show N shows more")


def _session():
    """The active session, or one with the submitted master and settings."""
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from roadpulse.session import build_session
    return build_session()


if __name__ == "__main__":
    main()
