"""Tables known by name: days are replaced by pointing the catalogue at fresh folders.

A swap of folders leaves a moment without the day. Here the new rows are written to a folder
of their own run and the day's partition is then pointed at it, which is one change in the
catalogue. Who planned a read before goes on with the old files; they stay until
:func:`remove_unused` finds them old enough. One writer per table at a time, as everywhere.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.plans.append import _write, append, conform, spread_by_day, with_day
from fleetlake.plans.compaction import merged
from fleetlake.sources.layers import stored_days
from fleetlake.sources.paths import age_seconds, exists, files, move, remove, subfolders

# Folder of a table that holds its runs; readers by path skip it.
RUNS = "_runs"
KEEP_HOURS = 24


def register(spark: SparkSession, name: str, table: str, path: str) -> None:
    """Make the table at ``path`` known as ``name`` with the days it holds; safe to repeat."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TABLES[table])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, dt DATE) "
        f"USING parquet PARTITIONED BY (dt) LOCATION '{path}'"
    )
    _add(spark, name, {day: f"{path}/dt={day}" for day in stored_days(spark, path)}, known_days(spark, name))


def known_days(spark: SparkSession, name: str) -> set[str]:
    """Days the catalogue has a partition for."""
    return {row[0].removeprefix("dt=") for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def location(spark: SparkSession, name: str, day: str | None = None) -> str:
    """Where the table lies, or one of its days."""
    part = f" PARTITION (dt = '{day}')" if day else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}{part}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _add(spark: SparkSession, name: str, folders: dict[str, str], known: set[str]) -> None:
    fresh = sorted(folders.keys() - known)
    if fresh:
        parts = " ".join(f"PARTITION (dt = '{day}') LOCATION '{folders[day]}'" for day in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def append_rows(rows: DataFrame, name: str, table: str) -> int:
    """Append rows where each day lies now; new days are known at once. Returns how many.

    They are written once, aside, and their files moved into the folders of their days.
    """
    spark = rows.sparkSession
    path, known = location(spark, name), known_days(spark, name)
    run = _run()
    aside = f"{path}/{RUNS}/{run}"
    written = append(rows, aside, table)
    places = {}
    for day in sorted(stored_days(spark, aside)):
        places[day] = location(spark, name, day) if day in known else f"{path}/dt={day}"
        for file in files(spark, f"{aside}/dt={day}", ".parquet"):
            move(spark, f"{aside}/dt={day}/{file}", f"{places[day]}/{run}-{file}")
    remove(spark, aside)
    _add(spark, name, places, known)
    spark.catalog.refreshTable(name)
    return written


def _run() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"


def replace_days(rows: DataFrame, name: str, table: str, days: Iterable[str] | None = None) -> int:
    """Let the days of ``rows`` hold exactly these rows; returns how many were written.

    ``days`` are replaced too where no row is left of them: they are dropped. Readers see a
    day as it was or as it is, never without files.
    """
    spark = rows.sparkSession
    folder = f"{location(spark, name)}/{RUNS}/{_run()}"
    rows = spread_by_day(with_day(conform(rows, table), table)).sortWithinPartitions("dt", schemas.TIME_COLUMN[table])
    written = _write(rows, folder, "overwrite")
    held, known = stored_days(spark, folder), known_days(spark, name)
    _add(spark, name, {day: f"{folder}/dt={day}" for day in held}, known)
    for day in sorted(held & known):
        spark.sql(f"ALTER TABLE {name} PARTITION (dt = '{day}') SET LOCATION '{folder}/dt={day}'")
    for day in sorted((set(days or ()) - held) & known):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt = '{day}')")
    spark.catalog.refreshTable(name)
    return written


def replace_all(rows: DataFrame, name: str, table: str) -> int:
    """Let the table hold exactly ``rows``; days that these lack are dropped last."""
    return replace_days(rows, name, table, known_days(rows.sparkSession, name))


def compact_into(rows: DataFrame, name: str, table: str) -> int:
    """Merge ``rows`` into the days of a named table, every row as often as the side that has it more often.

    Returns what those days then hold.
    """
    spark = rows.sparkSession
    rows = with_day(rows, table)
    # One value per calendar day.
    days = {r[0].isoformat() for r in rows.select("dt").distinct().collect() if r[0] is not None}
    if not days:
        return 0
    rows = with_day(conform(rows, table), table)
    known = days & known_days(spark, name)
    if known:
        rows = merged(rows, spark.table(name).where(F.col("dt").isin(sorted(known))).select(*rows.columns))
    return replace_days(rows, name, table)


def remove_unused(spark: SparkSession, name: str, keep_hours: float = KEEP_HOURS) -> int:
    """Remove folders of days that no partition points at any more; returns how many.

    Folders younger than ``keep_hours`` stay, for readers that planned before the change.
    """
    path = location(spark, name)
    used = {location(spark, name, day).rstrip("/").split(":", 1)[-1] for day in known_days(spark, name)}
    homes = [path, *[f"{path}/{RUNS}/{run}" for run in subfolders(spark, f"{path}/{RUNS}")]]
    removed = 0
    for home in homes:
        for day in stored_days(spark, home):
            folder = f"{home}/dt={day}"
            if folder.split(":", 1)[-1] not in used and age_seconds(spark, folder) >= keep_hours * 3600:
                remove(spark, folder)
                removed += 1
        if home != path and not stored_days(spark, home) and exists(spark, home):
            remove(spark, home)
    return removed
