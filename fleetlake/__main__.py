"""Command line for the lake jobs, to be run with spark-submit or ``python -m fleetlake``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from fleetlake.functions import parse_target_ids
from fleetlake.plans import compaction, daily, dedup, retention, status
from fleetlake.plans.append import create_tables
from fleetlake.sources.files import read_catalog
from fleetlake.sources.layers import Lake, read_table

TABLES = ("positions", "predictions")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fleetlake")
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="now, if not given")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("init", help="register the tables")
    compact = jobs.add_parser("compact", help="bronze to silver")
    compact.add_argument("--date", type=date.fromisoformat, default=None, help="all days, if not given")
    purge = jobs.add_parser("purge", help="drop rows older than the hot window")
    purge.add_argument("--days", type=int, default=retention.KEEP_DAYS)
    purge.add_argument("--dry-run", action="store_true")
    jobs.add_parser("dedup", help="remove stored duplicates")
    analyse = jobs.add_parser("status", help="rebuild the fleet status")
    analyse.add_argument("--source", choices=["silver", "bronze"], default="bronze")
    jobs.add_parser("health", help="freshness and last batch of the bronze tables")
    jobs.add_parser("reconcile", help="compare bronze with silver by day")
    collect = jobs.add_parser("collect", help="landed snapshots to bronze")
    collect.add_argument("--positions", help="folder of landed position snapshots")
    collect.add_argument("--predictions", help="folder of landed prediction snapshots")
    collect.add_argument("--catalog", help="line catalogue, for positions")
    collect.add_argument("--targets", default="", help="line ids, as in 1,2,3")
    return parser


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> list[str]:
    """Run one job; returns (and the command prints) a line per table."""
    options = _parser().parse_args(arguments)
    lake = Lake(options.root)
    as_of = options.as_of or datetime.now()
    bronze = {t: lake.path("bronze", t) for t in TABLES}
    if options.job == "init":
        return create_tables(spark, options.root)
    if options.job == "status":
        return [f"fleet_status: {status.refresh_fleet_status(spark, lake, options.source)} rows"]
    if options.job == "health":
        return [str(r.asDict()) for r in daily.check_health(spark, lake, as_of).collect()]
    if options.job == "collect":
        return _collect(spark, lake, options, as_of)
    lines = []
    for table, path in bronze.items():
        if options.job == "compact":
            rows = compaction.compact(
                read_table(spark, path, table), lake.path("silver", table), table, options.date
            )
            lines.append(f"{table}: {rows} rows written")
        elif options.job == "dedup":
            lines.append(f"{table}: {dedup.remove_duplicates(spark, path, table)} rows removed")
        elif options.job == "reconcile":
            days = daily.check_layers(spark, lake, table, as_of).where("not passed").orderBy("dt")
            lines += [f"{table}: {r['dt']} is {r['diff_pct']} % off" for r in days.collect()]
        elif options.dry_run:
            tables = {table: read_table(spark, path, table)}
            count = retention.dry_run(tables, options.days, as_of).first()["to_remove"]
            lines.append(f"{table}: {count} rows would be removed")
        else:
            lines.append(f"{table}: {daily.purge_table(spark, lake, table, as_of, options.days)} rows removed")
    return lines


def _collect(spark: SparkSession, lake: Lake, options: argparse.Namespace, as_of: datetime) -> list[str]:
    lines = []
    if options.positions:
        catalog = read_catalog(spark, options.catalog)
        targets = parse_target_ids(options.targets)
        rows = daily.collect_positions(spark, lake, options.positions, as_of, catalog, targets)
        lines.append(f"positions: {rows} rows added")
    if options.predictions:
        rows = daily.collect_predictions(spark, lake, options.predictions, as_of)
        lines.append(f"predictions: {rows} rows added")
    return lines


if __name__ == "__main__":
    session = SparkSession.builder.appName("fleetlake").getOrCreate()
    for line in run(session):
        print(line)
    session.stop()
