"""Removing duplicates that are already stored."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators.pick import keep_first
from fleetlake.plans.append import _write, spread_by_day
from fleetlake.sources.layers import read_table
from fleetlake.sources.paths import STAGED, recover, remove, swap_in


def remove_duplicates(spark: SparkSession, path: str, table: str) -> int:
    """Keep the row with the smallest id of every natural key; returns the rows removed.

    NULLs in the key count as equal. The collection time is part of the key, so copies
    share a day: only days that hold copies are written anew, each put in place whole.
    """
    recover(spark, path)
    key = [*schemas.NATURAL_KEYS[table], "dt"]
    rows = read_table(spark, path, table)
    copies = (
        rows.groupBy(*key)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .where(F.col("extra") > 0)
        .groupBy("dt")
        .agg(F.sum("extra").alias("extra"))
        .collect()  # a row per calendar day
    )
    if not copies:
        return 0
    days = sorted(r["dt"] for r in copies)
    staged = f"{path}/{STAGED}"
    kept = keep_first(rows.where(F.col("dt").isin(days)), key, ["id"])
    _write(spread_by_day(kept), staged, "overwrite")
    for day in days:
        swap_in(spark, f"{staged}/dt={day}", f"{path}/dt={day}")
    remove(spark, staged)
    spark.catalog.refreshByPath(path)
    return sum(r["extra"] for r in copies)
