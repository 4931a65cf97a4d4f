"""Command line for the tasks the original services ran: the daily job, ingest,
and the two lookups, as batch commands over shared storage.

    python -m wayfare.cli job --events PATH_OR_TABLE --lookup CSV --target DIR [--as-of TS]
    python -m wayfare.cli normalize --raw CSV --out DIR_OR_TABLE --rejects DIR
    python -m wayfare.cli publish --events PATH_OR_TABLE --topic DIR
    python -m wayfare.cli ingest --source DIR --lake DIR_OR_TABLE --checkpoint DIR [--quarantine DIR]
    python -m wayfare.cli compact --lake DIR_OR_TABLE --before YYYY-MM-DD [--first-day YYYY-MM-DD] [--vacuum]
    python -m wayfare.cli latest --recs DIR --out DIR [--passengers CSV]
    python -m wayfare.cli on-day --recs DIR --day YYYY-MM-DD --out DIR [--passengers CSV]

Every command takes --checkpoint-dir, a folder that all executors share, and --option
KEY=VALUE (repeatable) for the connector it talks to: JDBC settings with --format jdbc (job,
latest, on-day), Kafka settings with --format kafka (publish, ingest). A target without a
slash is a table of the catalog.
"""

from __future__ import annotations

import argparse

from wayfare.operators.normalize import normalize_events
from wayfare.operators.serving import latest_recommendations, recommendations_on
from wayfare.plans.job import run_recommendation_job
from wayfare.schemas import LOOKBACK_DAYS
from wayfare.session import build_session
from wayfare.sinks import append_events, compact_events, ensure_event_table, publish_events, vacuum_events
from wayfare.sources.readers import scan_events, scan_lookup, scan_raw_csv, scan_recommendations, stream_payloads
from wayfare.streaming.ingest import ingest_stream


def _passengers(spark, path):
    return spark.read.option("header", "false").csv(path) if path else None


def _table(spark, target: str) -> bool:
    """Whether ``target`` names a catalog table, which is created if need be."""
    if "/" in target:
        return False
    ensure_event_table(spark, target)
    return True


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="wayfare")
    sub = ap.add_subparsers(dest="cmd", required=True)
    j = sub.add_parser("job")
    j.add_argument("--events", required=True)
    j.add_argument("--lookup", required=True)
    j.add_argument("--target", required=True)
    j.add_argument("--as-of")
    j.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    j.add_argument("--mode", choices=["replace", "append"], default="replace")
    j.add_argument("--evaluate", action="store_true")
    j.add_argument("--exclude-seen", action="store_true")
    n = sub.add_parser("normalize")
    n.add_argument("--raw", required=True)
    n.add_argument("--out", required=True)
    n.add_argument("--rejects", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--format", default="text", choices=["text", "kafka"])
    i.add_argument("--lake", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--quarantine")
    i.add_argument("--max-per-trigger", type=int, default=1000)
    i.add_argument("--continuous", action="store_true")
    for name in ("latest", "on-day"):
        q = sub.add_parser(name)
        q.add_argument("--recs", required=True)
        q.add_argument("--out", required=True)
        q.add_argument("--passengers")
        if name == "on-day":
            q.add_argument("--day", required=True)
    c = sub.add_parser("compact")
    c.add_argument("--lake", required=True)
    c.add_argument("--before", required=True)
    c.add_argument("--first-day")
    c.add_argument("--vacuum", action="store_true")
    p = sub.add_parser("publish")
    p.add_argument("--events", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--format", default="text", choices=["text", "kafka"])
    n.add_argument("--files-per-day", type=int)
    n.add_argument("--multi-line", action="store_true")
    n.add_argument("--parallel", action="store_true")
    j.add_argument("--writers", type=int)
    j.add_argument("--buckets", type=int)
    for one in (j, sub.choices["latest"], sub.choices["on-day"]):
        one.add_argument("--format", default="parquet", choices=["parquet", "jdbc"])
    for one in sub.choices.values():
        one.add_argument("--checkpoint-dir")
        one.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    args = ap.parse_args(argv)
    options = dict(o.split("=", 1) for o in args.option)
    spark = build_session(conf={"spark.checkpoint.dir": args.checkpoint_dir} if args.checkpoint_dir else None)

    if args.cmd == "job":
        run = run_recommendation_job(scan_events(spark, args.events), scan_lookup(spark, args.lookup),
                                     as_of=args.as_of, lookback_days=args.lookback_days, evaluate=args.evaluate,
                                     target=args.target, target_fmt=args.format, target_mode=args.mode, target_options=options,
                                     num_writers=args.writers, buckets=args.buckets, exclude_seen=args.exclude_seen)
        if run.evaluation is not None:
            run.evaluation.show(truncate=False)
        run.release()
    elif args.cmd == "normalize":
        out = normalize_events(scan_raw_csv(spark, args.raw, multi_line=args.multi_line, parallel=args.parallel))
        append_events(out.events, args.out, files_per_day=args.files_per_day, table=_table(spark, args.out))
        out.rejects.write.mode("append").parquet(args.rejects)
    elif args.cmd == "publish":
        publish_events(scan_events(spark, args.events), args.format, args.topic, **options)
    elif args.cmd == "compact":
        table = _table(spark, args.lake)
        done = compact_events(spark, args.lake, args.before, args.first_day, table=table)
        print(f"packed {len(done.days)} days: {done.files_before} files into {done.files_after}")
        if args.vacuum:
            print(f"removed {vacuum_events(spark, args.lake, table=table)} partitions")
    elif args.cmd == "ingest":
        qs = ingest_stream(stream_payloads(spark, args.format, args.source, args.max_per_trigger, **options),
                           args.lake, args.checkpoint, args.quarantine, available_now=not args.continuous,
                           table=_table(spark, args.lake))
        qs.await_all()
    else:
        recs = scan_recommendations(spark, args.recs, args.format, **options)
        people = _passengers(spark, args.passengers)
        res = (latest_recommendations(recs, people) if args.cmd == "latest"
               else recommendations_on(recs, args.day, people))
        res.write.mode("overwrite").parquet(args.out)
    spark.stop()


if __name__ == "__main__":
    main()
