"""Batch and streaming jobs: ``spark-submit`` or ``python -m steadyline <job> --help``."""

from __future__ import annotations

import argparse

from steadyline.operators.headways import MAX_HEADWAY_SEC
from steadyline.plans import medallion
from steadyline.session import build_session
from steadyline.sources.payloads import parse_timetable_payloads
from steadyline.sources.tables import export_tables
from steadyline.sources.timetable_csv import read_timetable, write_timetable
from steadyline.streaming import bronze


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="steadyline")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("bronze", help="stream raw events into the log and state tables")
    job.add_argument("--format", default="kafka")
    job.add_argument("--path")
    job.add_argument("--schema")
    job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--log", required=True)
    job.add_argument("--current", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--drain", action="store_true", help="stop when the source is exhausted")

    job = jobs.add_parser("backfill", help="stored raw events → log and state tables, in one batch")
    job.add_argument("--raw", required=True, help="Parquet of value and, where known, seq")
    job.add_argument("--log", required=True)
    job.add_argument("--current", required=True)
    job.add_argument("--run-id", default="backfill")

    job = jobs.add_parser("compact", help="state table or log → state table with one row per key, in a new folder")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)

    job = jobs.add_parser("compact-log", help="position log → log in full files, in a new folder")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--date", action="append", default=[], help="a closed date; all dates if none is given")

    job = jobs.add_parser("payloads", help="landed position payloads → keyed JSON records")
    job.add_argument("--payloads", required=True, help="Parquet of (line, payload)")
    job.add_argument("--out", required=True)

    job = jobs.add_parser("delay", help="arrival events and timetable → delay tables")
    job.add_argument("--arrivals", required=True)
    job.add_argument("--timetable", required=True, help="CSV folder")
    job.add_argument("--namespace", required=True)
    job.add_argument("--late-sec", type=int, required=True)

    job = jobs.add_parser("arrivals", help="log → arrival events")
    job.add_argument("--log", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--keys", default="train_no")
    job.add_argument("--dt-from")
    job.add_argument("--dt-to")

    job = jobs.add_parser("headway-mart", help="arrival events → regularity mart")
    job.add_argument("--arrivals", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--max-headway-sec", type=int, default=MAX_HEADWAY_SEC)

    job = jobs.add_parser("freshness-mart", help="log → freshness mart")
    job.add_argument("--log", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--source-tz", default="UTC")

    job = jobs.add_parser("timetable", help="landed timetable payloads → CSV")
    job.add_argument("--payloads", required=True, help="Parquet of (line, payload)")
    job.add_argument("--out", required=True)

    job = jobs.add_parser("export", help="tables → CSV")
    job.add_argument("--out", required=True)
    job.add_argument("--single-file", action="store_true")
    job.add_argument("tables", nargs="+", metavar="NAME=TABLE")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"steadyline-{args.job}")
    if args.job == "bronze":
        source = bronze.read_events(
            spark, args.format, args.path, args.schema, **_pairs(args.option)
        )
        query = bronze.start_bronze(
            source,
            args.log,
            args.current,
            args.checkpoint,
            trigger={"availableNow": True} if args.drain else None,
        )
        query.awaitTermination()
    elif args.job == "backfill":
        bronze.backfill(spark.read.parquet(args.raw), args.log, args.current, args.run_id)
    elif args.job == "compact":
        bronze.compact_current(spark, args.source, args.target)
    elif args.job == "compact-log":
        dates = spark.createDataFrame([(d,) for d in args.date], "dt STRING") if args.date else None
        bronze.compact_log(spark, args.source, args.target, dates)
    elif args.job == "payloads":
        medallion.events_from_payloads(spark.read.parquet(args.payloads)).write.parquet(args.out)
    elif args.job == "delay":
        names = ("arrival_delay", "delay_by_station", "delay_by_timeband")
        written = medallion.build_delay_tables(
            medallion.stored_arrivals(spark, args.arrivals),
            read_timetable(spark, args.timetable),
            {name: f"{args.namespace}.{name}" for name in names},
            args.late_sec,
        )
        written["delay_by_timeband"].show(50, truncate=False)
    elif args.job == "arrivals":
        medallion.build_arrivals(
            bronze.read_position_log(spark, args.log),
            args.out,
            tuple(args.keys.split(",")),
            extra=("direct_at",),
            dt_from=args.dt_from,
            dt_to=args.dt_to,
        )
    elif args.job == "headway-mart":
        _mart, ranking = medallion.build_headway_mart(
            medallion.stored_arrivals(spark, args.arrivals), args.table, args.max_headway_sec
        )
        ranking.show(50, truncate=False)
    elif args.job == "freshness-mart":
        _mart, cover, gaps = medallion.build_freshness_mart(
            bronze.read_position_log(spark, args.log), args.table, args.source_tz
        )
        cover.orderBy("line").show(truncate=False)
        gaps.orderBy("line").show(truncate=False)
    elif args.job == "timetable":
        write_timetable(parse_timetable_payloads(spark.read.parquet(args.payloads)), args.out)
    elif args.job == "export":
        report = export_tables(spark, _pairs(args.tables), args.out, args.single_file)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
