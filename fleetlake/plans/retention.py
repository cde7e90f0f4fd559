"""The hot window: rows older than a limit leave the bronze layer."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.functions import local_time
from fleetlake.plans.compaction import unarchived
from fleetlake.sources.layers import read_table, stored_days
from fleetlake.sources.paths import STAGED, recover, remove, swap_in

# Fixed value: days kept.
KEEP_DAYS = 7


def cutoff(as_of: datetime, keep_days: int = KEEP_DAYS) -> datetime:
    """Rows collected before this moment are out of the window."""
    return as_of - timedelta(days=keep_days)


def dry_run(
    tables: Mapping[str, DataFrame], keep_days: int = KEEP_DAYS, as_of: datetime | None = None
) -> DataFrame:
    """(table_name, to_remove): what a purge would take, changing nothing.

    Without ``as_of`` the window ends at each table's newest row. Rows are counted per
    collection first, so that the newest one and the old ones come from one small table.
    With ``as_of``, stored tables are pruned to the days that can hold old rows.
    """
    parts = []
    for name, df in tables.items():
        if as_of and "dt" in df.columns:
            df = df.where(F.col("dt") <= F.lit(cutoff(as_of, keep_days).date()))
        batches = df.groupBy("collected_at").agg(F.count(F.lit(1)).alias("n"))
        end = local_time(as_of) if as_of else batches.agg(F.max("collected_at")).scalar()
        old = batches.where(F.col("collected_at") < _start(end, keep_days))
        parts.append(
            old.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("to_remove")).select(
                F.lit(name).alias("table_name"), "to_remove"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _start(end: Column, keep_days: int) -> Column:
    return end - F.make_dt_interval(days=F.lit(keep_days))


def purge(
    spark: SparkSession,
    path: str,
    table: str,
    limit: datetime,
    archive_path: str | None = None,
    archived: set[str] | None = None,
) -> int:
    """Remove rows collected before ``limit``; returns how many.

    With ``archive_path`` a day stays whole unless that table holds every row of it that
    would go, each as often as here. ``archived`` names the days for which that is known
    already; others stay. Days that end before the limit go as whole folders.
    Only the day the limit falls into is rewritten: its survivors are written aside, then
    take the folder's place.
    """
    recover(spark, path)
    boundary = limit.date().isoformat()
    days = {d for d in stored_days(spark, path) if d <= boundary}
    if archived is not None:
        days &= archived
    if not days:
        return 0
    rows = read_table(spark, path, table)
    moment = local_time(limit)
    time = F.col(schemas.TIME_COLUMN[table])
    expired = rows.where(F.col("dt").isin(sorted(days)) & (time < moment))
    if archive_path is not None:
        archive = read_table(spark, archive_path, table).where(F.col("dt").isin(sorted(days)))
        # At most one row per calendar day.
        days -= {r["dt"].isoformat() for r in unarchived(expired, archive).collect()}
    whole = sorted(days - {boundary})
    removed = rows.where(F.col("dt").isin(whole)).count() if whole else 0  # from file footers

    if boundary in days:
        boundary_rows = rows.where(F.col("dt") == F.lit(boundary))
        gone = boundary_rows.where(time < moment).count()
        if gone:
            _rewrite_day(spark, boundary_rows.where(time >= moment), path, boundary)
        removed += gone
    for day in whole:
        remove(spark, f"{path}/dt={day}")
    spark.catalog.refreshByPath(path)
    return removed


def _rewrite_day(spark: SparkSession, survivors: DataFrame, path: str, day: str) -> None:
    if survivors.isEmpty():
        remove(spark, f"{path}/dt={day}")
        return
    staged = f"{path}/{STAGED}/dt={day}"
    survivors.drop("dt").write.mode("overwrite").parquet(staged)
    swap_in(spark, staged, f"{path}/dt={day}")
    remove(spark, f"{path}/{STAGED}")
