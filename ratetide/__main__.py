"""Command line: the batch DAG, the event ingest, its compaction and the rate backfill.

    python -m ratetide run --transactions DIR --rates DIR --yields DIR \\
        --rate-events DIR --out DIR [--targets a,b | --scheduled SOURCE] [--warn]
    python -m ratetide ingest --source DIR --sink DIR --quarantine DIR \\
        --checkpoint DIR [--continuous SECONDS]
    python -m ratetide compact --sink DIR --table DIR [--all-batches]
    python -m ratetide backfill-rates --out DIR

Paths are read as landed: transactions as headerless CSV (hive-style
``year=/run_date=`` folders allowed), rates and yields as NDJSON, rate
events as the Parquet table the ingest writes (and, with ``--events-table``,
the table that ``compact`` made of it).
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m ratetide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="build models (all, --targets, or --scheduled)")
    for name in ("transactions", "rates", "yields", "rate-events"):
        r.add_argument(f"--{name}", help="needed by models that read it")
    r.add_argument("--out", required=True)
    r.add_argument("--targets", default=None, help="comma-separated model names")
    r.add_argument("--scheduled", default=None, choices=("transactions", "rates", "yields"),
                   help="what a load of this source refreshes; other tables stay as they are")
    r.add_argument("--warn", action="store_true", help="record failed checks, do not abort")
    r.add_argument("--no-checks", action="store_true")
    r.add_argument("--no-raw-gate", action="store_true",
                   help="do not validate the newest landed transaction and rate batches first")
    r.add_argument("--split-csv", action="store_true",
                   help="read transaction files in parallel where a pass over them finds no record over several lines")
    r.add_argument("--events-table", help="compacted event table, read beside --rate-events")
    r.add_argument("--shuffle-partitions", type=int, default=None,
                   help="default: sized to the bytes of the input files")
    r.add_argument("--full-refresh", action="store_true", help="rebuild the monthly mart")
    i = sub.add_parser("ingest", help="stream rate-change messages into the event table")
    for name in ("source", "sink", "quarantine", "checkpoint"):
        i.add_argument(f"--{name}", required=True)
    i.add_argument("--continuous", type=int, default=None,
                   help="trigger interval in seconds (default: process what is there, stop)")
    c = sub.add_parser("compact", help="merge ingested micro-batches into a table by month")
    for name in ("sink", "table"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--all-batches", action="store_true",
                   help="also the newest batch of each ingest; none may be running or restarted")
    b = sub.add_parser("backfill-rates", help="truncate-load the fixed rate history")
    b.add_argument("--out", required=True)
    return ap


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    from .session import get_session

    spark = spark or get_session()
    if args.cmd == "run":
        from .plans.runner import SCHEDULES, run_pipeline
        from .session import input_bytes, shuffle_partitions_for
        from .sources import csv_split, files
        from .streaming.compact import read_events

        csv = csv_split.read_transactions_csv_split if args.split_csv else files.read_transactions_csv
        readers = {
            "transactions": lambda p: csv(spark, p),
            "rates": lambda p: files.read_rates_json(spark, p),
            "yields": lambda p: files.read_yields_json(spark, p),
            "rate_events": lambda p: (read_events(spark, p, args.events_table) if args.events_table
                                      else spark.read.parquet(p)),
        }
        given = {n: getattr(args, n) for n in readers if getattr(args, n)}
        spark.conf.set("spark.sql.shuffle.partitions", args.shuffle_partitions or shuffle_partitions_for(
            input_bytes(spark, given.values())))
        raw = {n: readers[n](p) for n, p in given.items()}
        targets = (SCHEDULES[args.scheduled] if args.scheduled
                   else args.targets.split(",") if args.targets else None)
        res = run_pipeline(spark, raw, args.out, targets=targets, check=not args.no_checks,
                           raw_suites={} if args.no_raw_gate else None,
                           on_failure="warn" if args.warn else "raise",
                           incremental=not args.full_refresh, reuse_tables=bool(args.scheduled))
        out = {"tables": res.paths,
               "failed_checks": {t: [c for c in rows if not c["success"]]
                                 for t, rows in res.checks.items()}}
    elif args.cmd == "ingest":
        from .streaming.events import start_ingest

        q = start_ingest(spark, args.source, args.sink, args.quarantine, args.checkpoint,
                         available_now=args.continuous is None,
                         processing_time=f"{args.continuous or 10} seconds")
        q.awaitTermination()
        out = {"ingested": args.sink}
    elif args.cmd == "compact":
        from .streaming.compact import compact_events

        out = {"folders": compact_events(spark, args.sink, args.table, keep_newest=not args.all_batches)}
    else:
        from .plans.rates import backfill_rates

        out = {"rows": backfill_rates(spark, args.out)}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
