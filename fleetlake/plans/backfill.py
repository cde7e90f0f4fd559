"""Copying tables into the lake in slices of days, safe to break off and to repeat.

A slice is staged, what it adds is written aside, moved into the table and marked as done. A
call that follows a broken one goes on with the slice that was not marked, and rows that were
moved are not moved again, so rows with a NULL in the key come in once as well. Once
all slices are done the marks go, and a later call starts over.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.plans.append import idempotent_append, publish
from fleetlake.session import staged
from fleetlake.sources.layers import Lake, read_table
from fleetlake.sources.paths import exists, move, remove, subfolders

COUNTS = "table_name string, source_rows bigint, target_rows bigint"
#: Days of a slice; slices lie on a fixed grid, so a call that resumes finds the same ones.
SLICE_DAYS = 31
UNTIMED = "untimed"


def _slices(rows: DataFrame, time: str, days: int) -> dict[str, Column]:
    """Names of the slices that can hold rows, in order, with the rows that belong to each."""
    first, last, untimed = rows.agg(F.min(time), F.max(time), F.count_if(F.col(time).isNull())).first()
    found = {}
    if first is not None:
        start = date.fromordinal(first.toordinal() // days * days)
        while start <= last.date():
            bounds = [F.lit(str(d)).cast("timestamp_ntz") for d in (start, start + timedelta(days=days))]
            found[start.isoformat()] = (F.col(time) >= bounds[0]) & (F.col(time) < bounds[1])
            start += timedelta(days=days)
    if untimed:
        found[UNTIMED] = F.col(time).isNull()
    return found


def _run_id(spark: SparkSession, folder: str) -> str:
    """The id of the unfinished run whose marks lie in ``folder``, or a new one."""
    return next((name[3:] for name in subfolders(spark, folder) if name.startswith("id=")), uuid.uuid4().hex)


def _take_slice(
    spark: SparkSession, rows: DataFrame, lake: Lake, table: str, order: Sequence[str], run: str, name: str, work: str
) -> None:
    """Bring one slice into bronze; every step that was finished is passed over or changes nothing."""
    aside, bronze = f"{work}/aside/{name}", lake.path("bronze", table)
    if not exists(spark, f"{aside}/counts/_SUCCESS"):
        remove(spark, f"{work}/aside")
        counted = Observation()
        batch = staged(rows.observe(counted, F.count(F.lit(1)).alias("n")), f"{aside}/batch")
        n = counted.get["n"]
        if n:
            quarantine = f"{lake.path('quarantine', table)}/run=backfill-{run}-{name}"
            idempotent_append(batch, bronze, table, order, quarantine, f"{aside}/rows")
        spark.createDataFrame([(n,)], "source_rows bigint").coalesce(1).write.parquet(f"{aside}/counts")
    publish(spark, f"{aside}/rows", bronze, f"backfill-{run}-{name}")
    move(spark, f"{aside}/counts", f"{work}/done/slice={name}")
    remove(spark, f"{work}/aside")


def backfill(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake: Lake,
    order: Sequence[str] = ("id",),
    slice_days: int = SLICE_DAYS,
    at_most: int | None = None,
) -> DataFrame:
    """Append each source to its bronze table; returns source and target row counts.

    Empty sources are skipped and not listed. Rows without a required column go to the
    quarantine layer. A slice reads its span of time from the source, which prunes a source
    that is laid out by time. ``at_most`` ends the call after so many slices of a table; the
    next call goes on. The counts cover the slices done so far.
    """
    counts = []
    for table, rows in sources.items():
        folder = f"{lake.path('state', 'backfill')}/{table}"
        run = _run_id(spark, folder)
        work = f"{folder}/id={run}"
        slices = _slices(rows, schemas.TIME_COLUMN[table], slice_days)
        if not slices:
            continue
        done = {name.removeprefix("slice=") for name in subfolders(spark, f"{work}/done")}
        waiting = [name for name in slices if name not in done]
        for name in waiting[:at_most]:
            _take_slice(spark, rows.where(slices[name]), lake, table, order, run, name, work)
        marks = spark.read.schema("source_rows bigint").parquet(f"{work}/done")
        counts.append((table, marks.agg(F.sum("source_rows")).first()[0], read_table(spark, lake.path("bronze", table), table).count()))
        if at_most is None or len(waiting) <= at_most:
            remove(spark, folder)
    return spark.createDataFrame(counts, COUNTS)
