"""Command line: load CSV files, update the warehouse, find and export voyages."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from fairlead.functions.columns import ACTIVE_STATUS, GAP_SECONDS
from fairlead.plans.voyages import run_voyages
from fairlead.plans.warehouse import load_csv, update_warehouse
from fairlead.session import local_session
from fairlead.sources.tables import Warehouse

log = logging.getLogger("fairlead")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fairlead", description=__doc__)
    top.add_argument("-w", "--warehouse", required=True, help="root folder of the tables")
    top.add_argument("--local", metavar="CORES", help="run in this process on so many cores")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="CSV files into staging")
    source = load.add_mutually_exclusive_group(required=True)
    source.add_argument("-c", "--csv_file", help="CSV file to load")
    source.add_argument("-f", "--folder", help="folder with CSV files, searched at any depth")
    load.add_argument("--lenient", action="store_true", help="set bad rows aside")
    load.add_argument("--mixed_headers", action="store_true", help="files differ in their columns")
    load.add_argument("--timestamp_format", help="pattern of the time stamps, if not ISO")

    update = commands.add_parser("update", help="staging into ships, statuses and positions")
    update.add_argument("--strict", action="store_true", help="fail on rows without a point")

    voyages = commands.add_parser("voyages", help="find and export voyages")
    voyages.add_argument("-s", "--skip_finding", action="store_true")
    voyages.add_argument("-x", "--export", action="store_true")
    voyages.add_argument("--ships", type=int, nargs=2, metavar=("MIN", "MAX"))
    voyages.add_argument("--gap_seconds", type=int, default=GAP_SECONDS)
    voyages.add_argument("--active", default=ACTIVE_STATUS, help="status of a ship under way")
    voyages.add_argument("--increment", choices=["carry", "parity", "full"], default="carry")

    compact = commands.add_parser("compact", help="positions of all updates into one folder, day by day")
    compact.add_argument("--remove", action="store_true", help="delete the folders it replaces; no reader may be on them")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        spark = local_session(args.local) if args.local else SparkSession.builder.getOrCreate()
    warehouse = Warehouse(spark, args.warehouse)
    if args.command == "load":
        stored = load_csv(
            warehouse,
            args.csv_file or args.folder,
            "lenient" if args.lenient else "strict",
            mixed_headers=args.mixed_headers,
            timestamp_format=args.timestamp_format,
        )
        log.info("%d rows stored", stored)
    elif args.command == "update":
        ids = update_warehouse(warehouse, args.strict)
        if ids is None:
            log.warning("no new rows in staging")
        else:
            log.info("rows %d to %d brought into the warehouse", *ids)
    elif args.command == "compact":
        number = warehouse.compact()
        removed = warehouse.remove_replaced() if args.remove else 0
        log.info("compaction %s, %d folders removed", number, removed)
    elif args.skip_finding and not args.export:
        log.warning("nothing to do: finding is skipped and no export asked for")
    else:
        mode = "export" if args.skip_finding else "find_export" if args.export else "find"
        ships = tuple(args.ships) if args.ships else None
        rules = {}
        if mode != "export":
            rules = {"gap_seconds": args.gap_seconds, "active": args.active}
        run = run_voyages(warehouse, mode, ships, args.increment, **rules)
        log.info("run %d: %s, %d late reports, %d voyages taken back", run.run_id, mode, run.late, run.taken_back)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
