"""Joins and broadcasts that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from fleetlake.session import scratch_path, staged

# A key with fewer rows than this is never worth splitting.
MIN_HOT_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
# Below this estimate the planner broadcasts by itself (its default threshold).
MEASURE_ABOVE_BYTES = 10 * 1024 * 1024


def task_count(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate; costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_HOT_ROWS) -> list[Row]:
    """Keys that hold more than one task's fair share of the rows, with a split count.

    With T tasks a key is hot above total/T rows, so there are fewer than T of them:
    the list that reaches the driver is bounded by the task count, not by the data.
    Counting combines on the map side and reads the key columns only.
    """
    total = df.count()
    if total < min_rows:
        return []
    tasks = task_count(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.where((F.col("_n") >= min_rows) & (F.col("_n") * tasks > total))
    return heavy.select(
        *keys, F.ceil(F.col("_n") * F.lit(2 * tasks) / total).cast("int").alias("_splits")
    ).collect()


def hot_table(df: DataFrame, keys: Sequence[str], rows: list[Row]) -> DataFrame:
    """The result of :func:`hot_keys` as a broadcast table."""
    schema = df.select(*keys, F.lit(1).alias("_splits")).schema
    for field in schema:
        field.nullable = True
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: a word per column, and the bytes of texts."""
    size = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows, summed where they lie."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the table.

    A table the planner estimates below its own threshold, or one that measures too
    large, is left to the planner.
    """
    if estimated_bytes(df) <= MEASURE_ABOVE_BYTES:
        return df
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def left_join_unique(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    min_rows: int = MIN_HOT_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left join ``fact`` to a ``lookup`` that has one row per key.

    The lookup is computed once and measured while it is written. If it may be broadcast, the fact table is joined where it is read,
    without a shuffle. If not, both sides shuffle, and rows of a hot key are dealt out
    over ``_splits`` salts by a hash of ``spread_by``; only the lookup rows of hot keys
    are repeated, at most 3T rows in all. The salt is a function of the row, so a
    recomputed task deals the same way.
    """
    keys = list(keys)
    counted = Observation()
    sized = lookup.observe(counted, F.coalesce(F.sum(row_bytes(lookup)), F.lit(0)).alias("bytes"))
    lookup = staged(sized, scratch_path(fact.sparkSession, "lookup"))
    if counted.get["bytes"] <= max_broadcast_bytes:
        return fact.join(F.broadcast(lookup), keys, "left")
    hot = hot_keys(fact, keys, min_rows)
    if not hot:
        return fact.join(lookup, keys, "left")
    splits = hot_table(fact, keys, hot)

    salted_fact = _with_splits(fact, splits, keys).withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.col("_splits")).cast("int")
    )
    salted_lookup = _with_splits(lookup, splits, keys).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))
    )
    return salted_fact.drop("_splits").join(
        salted_lookup.drop("_splits"), [*keys, "_salt"], "left"
    ).drop("_salt")


def _with_splits(df: DataFrame, splits: DataFrame, keys: list[str]) -> DataFrame:
    renamed = splits.withColumnsRenamed({key: f"_hot_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    joined = df.join(F.broadcast(renamed), same, "left").drop(*[f"_hot_{key}" for key in keys])
    return joined.withColumn("_splits", F.coalesce("_splits", F.lit(1)))
