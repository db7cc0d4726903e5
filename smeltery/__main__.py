"""Command line: ``python -m smeltery --lake FOLDER ingest|clean|metrics|flags|runs|demo ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame

from smeltery import build_session, schemas
from smeltery.operators import ledger, rollup
from smeltery.plans import jobs
from smeltery.sources.tables import Lake
from smeltery.streaming.discovery import ingest_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="smeltery")
    top.add_argument("--lake", required=True, help="folder of the tables")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("ingest", "demo"):
        command = commands.add_parser(name)
        command.add_argument("--source", required=True)
        command.add_argument("paths", nargs="+")
        if name == "ingest":
            command.add_argument("--set-aside", action="store_true", help="keep rows that break the contract in a table of their own")
        if name == "demo":
            command.add_argument("--out", required=True)
    watch = commands.add_parser("watch", help="ingest the files of a folder that are new since the last time")
    for option in ("--source", "--folder", "--checkpoint"):
        watch.add_argument(option, required=True)
    watch.add_argument("--set-aside", action="store_true")
    clean = commands.add_parser("clean")
    clean.add_argument("--limit", type=int, help="so many of the newest rows; default: all not yet cleaned")
    clean.add_argument("--everything", action="store_true", help="clean all rows anew")
    commands.add_parser("metrics")
    for name in ("monthly", "trend"):
        command = commands.add_parser(name)
        command.add_argument("--start", type=date.fromisoformat)
        command.add_argument("--end", type=date.fromisoformat)
        if name == "trend":
            command.add_argument("--by", choices=rollup.GRANULARITIES, default="day")
            command.add_argument("--metric", choices=schemas.MEASURES, default="total_records")
    flags = commands.add_parser("flags")
    flags.add_argument("--limit", type=int, help="so many of the newest rows; default: all")
    flags.add_argument("--out", required=True)
    commands.add_parser("runs")
    commands.add_parser("repair", help="keep one row of each key that bronze holds twice")
    return top


def print_all(rows: DataFrame) -> None:
    """Every row, a line each; rows come to the driver one partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark, lake = build_session(), Lake(args.lake)
    limit = getattr(args, "limit", None) or None
    if args.command == "ingest":
        print(jobs.ingest(spark, lake, args.source, args.paths, set_aside=args.set_aside))
    elif args.command == "watch":
        ingest_stream(spark, lake, args.source, args.folder, args.checkpoint, set_aside=args.set_aside).awaitTermination()
    elif args.command == "clean":
        print(f"Silver rows: {jobs.refresh_clean(spark, lake, limit, args.everything)}")
    elif args.command == "metrics":
        print_all(jobs.refresh_metrics(spark, lake).orderBy("month_start"))
    elif args.command == "monthly":
        print_all(rollup.monthly_slice(lake.read(spark, "monthly_metrics"), args.start, args.end))
    elif args.command == "trend":
        opening = rollup.last_days(date.today())
        span = args.start or opening[0], args.end or opening[1]
        print_all(rollup.trend(lake.read(spark, "daily_metrics"), *span, args.by, args.metric))
    elif args.command == "flags":
        done = jobs.flag_report(spark, lake, args.out, limit)
        print(f"{done.scanned} records scanned, {done.flagged} flagged, report in {done.path}")
        done.top.show(truncate=False)
    elif args.command == "runs":
        print_all(ledger.recent_runs(ledger.current(lake.read(spark, "pipeline_runs"))))
    elif args.command == "repair":
        print(f"Rows deleted: {jobs.repair(spark, lake)}")
    else:
        print(jobs.run_all(spark, lake, args.source, args.paths, args.out))


if __name__ == "__main__":
    main()
