"""Row counts, missing values, freshness and agreement between layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import local_time

# Tolerated difference between layers in percent; age limit in minutes.
TOLERANCE_PCT = 5.0
MAX_AGE_MINUTES = 60


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def null_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(metric, value): the total of each table and the NULLs of its listed columns.

    One pass per table, over the listed columns only.
    """
    audits = []
    for table, (df, columns) in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns],
        )
        metrics = F.array(
            *[
                F.struct(F.lit(f"{table}_{m}").alias("metric"), F.col(m).alias("value"))
                for m in counted.columns
            ]
        )
        audits.append(counted.select(F.inline(metrics)))
    return _union(audits)


def freshness(
    tables: Mapping[str, DataFrame], as_of: datetime, max_age_minutes: float = MAX_AGE_MINUTES
) -> DataFrame:
    """(table_name, is_empty, is_stale): whether the newest row is older than the limit."""
    limit = local_time(as_of) - F.make_dt_interval(mins=F.lit(max_age_minutes))
    newest = F.max("collected_at")
    return _union(
        [
            df.agg(newest.alias("newest")).select(
                F.lit(name).alias("table_name"),
                F.col("newest").isNull().alias("is_empty"),
                (F.col("newest") < limit).alias("is_stale"),
            )
            for name, df in tables.items()
        ]
    )


def last_batch(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, batch_rows): rows of the newest collection, 0 only for an empty table.

    Rows are counted per collection and the newest count is kept: one scan, where a
    filter on ``max(collected_at)`` would take two.
    """
    return _union(
        [
            df.groupBy("collected_at")
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.max_by("n", "collected_at"), F.lit(0)).alias("batch_rows"))
            .select(F.lit(name).alias("table_name"), "batch_rows")
            for name, df in tables.items()
        ]
    )


def reconcile(
    bronze: DataFrame,
    silver: DataFrame,
    by_day: bool = False,
    tolerance_pct: float = TOLERANCE_PCT,
) -> DataFrame:
    """Row counts of two layers, their difference in percent of bronze, and the verdict.

    Both empty passes; an empty bronze beside a filled silver is 100 percent off.
    ``by_day`` compares the days that both layers hold, so that a purged hot window does
    not read as a loss. Days are taken from the ``dt`` partition column.
    """
    keys = ["dt"] if by_day else []
    none = F.lit(0).cast("bigint")
    counts = _union(
        [
            bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("bronze")).withColumn("silver", none),
            silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("silver")).withColumn("bronze", none),
        ]
    )
    both = counts.groupBy(*keys).agg(F.sum("bronze").alias("bronze"), F.sum("silver").alias("silver"))
    if by_day:
        both = both.where((F.col("bronze") > 0) & (F.col("silver") > 0))
    diff = (
        F.when(F.col("bronze") > 0, F.abs(F.col("bronze") - F.col("silver")) * 100.0 / F.col("bronze"))
        .when(F.col("silver") > 0, F.lit(100.0))
        .otherwise(F.lit(0.0))
    )
    return both.select(
        *keys,
        "bronze",
        "silver",
        F.round(diff, 1).alias("diff_pct"),
        (diff <= tolerance_pct).alias("passed"),
    )
