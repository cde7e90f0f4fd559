"""Where the lake's tables lie, and reading them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.sources.paths import exists, subfolders


@dataclass(frozen=True)
class Lake:
    """A root folder with ``<layer>/<table>/dt=YYYY-MM-DD/`` below it."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


def stored_days(spark: SparkSession, path: str) -> set[str]:
    """Days a table has a partition for, from its folder names; others are passed over."""
    names = (name[3:] for name in subfolders(spark, path) if name.startswith("dt="))
    return {name for name in names if re.fullmatch(r"\d{4}-\d{2}-\d{2}", name)}


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A partitioned table with its ``dt`` column; empty if nothing was written yet.

    The schema is given, so that opening a table reads no footers.
    """
    schema = schemas.partitioned(schemas.TABLES[table])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All columns of a silver table but the partition column."""
    return read_table(spark, path, table).drop("dt")


def read_newest_day(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of the last stored day, found from the folder names.

    The newest row of a table lies there, so monitors need not scan the history.
    """
    rows = read_table(spark, path, table)
    days = stored_days(spark, path)
    return rows.where(F.col("dt") == F.lit(max(days)).cast("date")) if days else rows


def load_layer(
    spark: SparkSession, lake: Lake, table: str, fall_back_if_empty: bool = False
) -> DataFrame:
    """The silver table if it is there, else bronze, else an empty frame.

    ``fall_back_if_empty`` also passes over a silver table that holds no rows.
    """
    silver = lake.path("silver", table)
    bronze = lake.path("bronze", table)
    if exists(spark, silver):
        rows = read_silver(spark, silver, table)
        if not (fall_back_if_empty and rows.isEmpty()):
            return rows
    return read_silver(spark, bronze, table)
