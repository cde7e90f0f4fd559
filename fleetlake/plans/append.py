"""Writing rows into partitioned tables, and refusing those already there.

Plain Parquet has no MERGE. One writer per table at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators.pick import has_null, ranked_row, unranked
from fleetlake.sources.layers import read_table, stored_days
from fleetlake.sources.paths import STAGED, exists, files, move, recover, split, swap_in


class IncompleteRows(ValueError):
    """Rows without a required column, and no place to keep them."""


def conform(rows: DataFrame, table: str) -> DataFrame:
    """The columns of ``table`` in order and type; absent ones are NULL, extras go."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.TABLES[table]
        ]
    )


def with_day(rows: DataFrame, table: str) -> DataFrame:
    """Add the ``dt`` partition column unless the rows bring it."""
    if "dt" in rows.columns:
        return rows
    return rows.withColumn("dt", F.to_date(schemas.TIME_COLUMN[table]))


def storable(table: str) -> Column:
    """True for rows that have every required column."""
    required = F.lit(True)
    for field in schemas.TABLES[table]:
        if not field.nullable:
            required = required & F.col(field.name).isNotNull()
    return required


def append(rows: DataFrame, path: str, table: str) -> int:
    """Append all rows; returns how many. Rows without the table's time are an error."""
    recover(rows.sparkSession, path)
    time = schemas.TIME_COLUMN[table]
    rows = conform(rows, table)
    timed = F.when(F.col(time).isNull(), F.raise_error(F.lit(f"a row of {table} has no {time}")))
    return _write(with_day(rows.withColumn(time, F.coalesce(time, timed.cast("timestamp_ntz"))), table), path, "append")


def idempotent_append(
    rows: DataFrame,
    path: str,
    table: str,
    order: Sequence[str] = ("id",),
    quarantine: str | None = None,
    aside: str | None = None,
) -> int:
    """Append the rows whose natural key is not stored yet; returns the rows written.

    With ``aside`` they are written to that folder instead, for :func:`publish`.

    Of equal keys within the batch the smallest ``order`` wins. A key with a NULL equals
    nothing, so such rows are always written. Rows without a required column go to
    ``quarantine``; without one they are an error. The batch is looked at once for its
    span of time; stored keys are read from that span only, by day folders and by row
    groups, as rows of a day lie in the order of their collections.
    """
    spark = rows.sparkSession
    recover(spark, path)
    time = schemas.TIME_COLUMN[table]
    complete = storable(table)
    found = rows.agg(
        F.min(F.when(complete, F.col(time))), F.max(F.when(complete, F.col(time))), F.count_if(~complete)
    ).first()
    first, last, refused = found
    if refused and quarantine is None:
        raise IncompleteRows(f"{refused} rows of {table} lack a required column")
    if refused:
        rows.where(~complete).write.mode("overwrite").parquet(quarantine)
    if first is None:
        return 0
    target = (path, "append") if aside is None else (aside, "overwrite")
    stored = read_table(spark, path, table).where(
        F.col("dt").between(first.date(), last.date())
        & F.col(time).between(*(F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (first, last)))
    )
    fresh = unseen(rows.where(complete), stored, schemas.NATURAL_KEYS[table], order)
    fresh = with_day(conform(fresh, table), table)
    many = last.date() - first.date() >= timedelta(days=1)
    return _write((spread_by_day(fresh) if many else fresh).sortWithinPartitions("dt", time), *target)


def publish(spark: SparkSession, aside: str, path: str, run: str) -> None:
    """Move the files of a finished folder into the table, each under a name that ``run`` gives.

    A call that broke off is repeated: files that were moved are no longer there to move.
    """
    for day in sorted(stored_days(spark, aside)):
        for name in files(spark, f"{aside}/dt={day}", ".parquet"):
            move(spark, f"{aside}/dt={day}/{name}", f"{path}/dt={day}/{run}-{name}")
    spark.catalog.refreshByPath(path)


def unseen(
    incoming: DataFrame, stored: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row per key of ``incoming``, for the keys that ``stored`` does not have.

    Stored keys and new rows meet in one aggregation: one shuffle, and copies of a key
    collapse on the map side however many there are. A window and an anti join would
    shuffle all copies, twice. Rows with a NULL in the key pass by the aggregation.
    """
    values = [c for c in incoming.columns if c not in key]
    offered = incoming.where(~has_null(key)).select(
        *key, F.lit(False).alias("_stored"), ranked_row(order, values).alias("_row")
    )
    known = stored.dropna(subset=list(key)).select(*key, F.lit(True).alias("_stored"))
    merged = (
        offered.unionByName(known, allowMissingColumns=True)
        .groupBy(*key)
        .agg(F.bool_or("_stored").alias("_stored"), F.min("_row").alias("_row"))
        .where(~F.col("_stored"))
    )
    fresh = merged.select(*key, *unranked("_row", order, values))
    return fresh.unionByName(incoming.where(has_null(key)).select(*fresh.columns))


def spread_by_day(rows: DataFrame) -> DataFrame:
    """Bring the rows of a day together, without putting a large day into one task.

    Rebalancing lets the adaptive planner split big days and merge small ones, so files
    come out near the advisory size.
    """
    return rows.hint("rebalance", F.col("dt"))


def replace_table(rows: DataFrame, path: str, table: str) -> int:
    """Replace the whole table; the old one stays until the new one is in place."""
    spark = rows.sparkSession
    recover(spark, path)
    parent, name = split(path)
    staged = f"{parent}/{STAGED}/{name}"
    written = _write(spread_by_day(with_day(conform(rows, table), table)), staged, "overwrite")
    swap_in(spark, staged, path)
    return written


def _write(rows: DataFrame, path: str, mode: str, **options: str) -> int:
    counted = Observation()
    (
        rows.observe(counted, F.count(F.lit(1)).alias("n"))
        .write.mode(mode)
        .options(**options)
        .partitionBy("dt")
        .parquet(path)
    )
    return counted.get["n"]


def table_location(root: str, name: str) -> str:
    """Where a table's rows are appended: the audit apart from the data."""
    return f"{root}/{'audit' if name == 'lineage_audit' else 'bronze'}/{name}"


def create_tables(spark: SparkSession, root: str, database: str = "fleet") -> list[str]:
    """Register the bronze tables and the audit over ``root``; safe to repeat.

    Repeating it also makes the days known that were written since.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.TABLES.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, dt DATE) "
            f"USING parquet PARTITIONED BY (dt) LOCATION '{table_location(root, name)}'"
        )
        if exists(spark, table_location(root, name)):
            spark.catalog.recoverPartitions(f"{database}.{name}")
    return [f"{database}.{name}" for name in schemas.TABLES]
