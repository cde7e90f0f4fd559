"""Bronze to silver, one day or everything, safe to repeat and without loss."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators.pick import keep_first
from fleetlake.plans.append import _write, conform, spread_by_day, with_day
from fleetlake.sources.layers import read_table, stored_days
from fleetlake.sources.paths import STAGED, recover, remove, swap_in


def compact(
    rows: DataFrame,
    path: str,
    table: str,
    day: date | None = None,
    drop_duplicates: bool = False,
) -> int:
    """Take ``rows`` of ``day`` (or of all days) into silver; returns what those days then hold.

    A stored day is merged with, never replaced by, what comes: bronze may hold only part
    of a day by then. A row is stored as often as the side that has it more often, so a
    second run changes nothing. Days are written aside and swapped in one by one. The day
    filter is on ``dt``, which prunes the source to one folder. Within a file rows are
    sorted by time, which narrows the row-group statistics. ``drop_duplicates`` keeps one
    row per natural key.
    """
    spark = rows.sparkSession
    recover(spark, path)
    rows = with_day(rows, table)
    if day is not None:
        rows = rows.where(F.col("dt") == F.lit(day))
    # One value per calendar day.
    days = {r[0].isoformat() for r in rows.select("dt").distinct().collect() if r[0] is not None}
    if not days:
        return 0
    rows = with_day(conform(rows, table), table)
    known = days & stored_days(spark, path)
    if known:
        rows = merged(rows, read_table(spark, path, table).where(F.col("dt").isin(sorted(known))))
    if drop_duplicates:
        rows = keep_first(rows, schemas.NATURAL_KEYS[table], ["id"], null_safe=False)
    staged = f"{path}/{STAGED}"
    sorted_rows = spread_by_day(rows).sortWithinPartitions("dt", schemas.TIME_COLUMN[table])
    written = _write(sorted_rows, staged, "overwrite")
    for one in sorted(days):
        swap_in(spark, f"{staged}/dt={one}", f"{path}/dt={one}")
    remove(spark, staged)
    spark.catalog.refreshByPath(path)
    return written


def _sides(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """How often each distinct row occurs in either, ``_new`` and ``_old``."""
    columns = rows.columns
    both = rows.select("*", F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        stored.select(*columns, F.lit(0).alias("_new"), F.lit(1).alias("_old"))
    )
    return both.groupBy(*columns).agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))


def merged(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Every row as often as the table that has it more often; one shuffle, copies combined before it."""
    often = F.greatest("_new", "_old").cast("int")
    return _sides(rows, stored).select(*rows.columns, F.explode(F.array_repeat(F.lit(0), often)).alias("_n")).drop("_n")


def unarchived(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """(dt, n) of the days with rows that ``stored`` lacks, and how many."""
    missing = F.col("_new") - F.col("_old")
    return _sides(rows, stored.select(*rows.columns)).where(missing > 0).groupBy("dt").agg(F.sum(missing).alias("n"))


def partition_counts(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(dt, n) of a written table; read from the file footers."""
    return read_table(spark, path, table).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def verify_day(spark: SparkSession, path: str, table: str, day: date) -> int:
    """Rows the partition of ``day`` holds after the write."""
    return read_table(spark, path, table).where(F.col("dt") == F.lit(day)).count()
