"""Command line: ``python -m docmill ingest|transform|summary``.

Exit code 0 when every record was processed, 2 when records failed, 1 (2 for a wrong
argument) when the run could not start.
"""

from __future__ import annotations

import argparse
import re
import sys
from datetime import date

from .config import EngineConfig, id_list
from .logs import log_as_json


def iso_date(value: str) -> date:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise argparse.ArgumentTypeError(f"{value!r} is no date of the form YYYY-MM-DD")
    try:
        return date.fromisoformat(value)
    except ValueError as fault:
        raise argparse.ArgumentTypeError(str(fault)) from fault


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docmill", description="Incremental processing of document collections")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("ingest", help="fetched items to landing")
    land.add_argument("--items", required=True, help="Parquet of fetched items with their payload")
    run = commands.add_parser("transform", help="landing to processed and quarantine")
    for command in (land, run):
        command.add_argument("--root", required=True, help="folder of the tables")
        command.add_argument("--start-date", required=True, type=iso_date, help="first day, inclusive")
        command.add_argument("--end-date", required=True, type=iso_date, help="last day, inclusive")
        command.add_argument("--bodies", type=id_list, help="ids, comma-separated (all by default)")
        command.add_argument("--strict", action="store_true", help="a start within a bucket leaves the bucket out")
        command.add_argument("--env-file", help="settings as NAME=value lines")
    summary = commands.add_parser("summary", help="Markdown of event logs")
    summary.add_argument("label")
    summary.add_argument("paths", nargs="+")
    summary.add_argument("--wall", help="file with the wall seconds")
    return parser


def main(argv: list[str] | None = None, spark=None) -> int:
    args = arguments().parse_args(argv)
    config = EngineConfig.from_env(path=getattr(args, "env_file", None))
    log_as_json(config.log_level)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("docmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    from .plans import runs

    if args.command == "summary":
        print(runs.summarise_logs(spark, args.label, *args.paths, wall_path=args.wall))
        return 0
    try:
        if args.command == "ingest":
            counts = runs.run_ingest(spark, args.root, args.items, args.start_date, args.end_date, args.bodies, config=config, strict=args.strict)
            return 2 if counts["failed"] else 0
        stats = runs.run_transform(spark, args.root, args.start_date, args.end_date, args.bodies, config=config, strict=args.strict)
    except ValueError as fault:
        print(fault, file=sys.stderr)
        return 1
    return 2 if stats["failed"] else 0


if __name__ == "__main__":
    sys.exit(main())
