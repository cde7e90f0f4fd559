"""Distance of every row to the next one of its group, in latitude order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions import haversine_km
from fleetlake.operators.skew import MIN_HOT_ROWS, hot_keys, hot_table, task_count
from fleetlake.session import scratch_path, staged


def adjacent_distances(
    df: DataFrame,
    group: Sequence[str],
    row_id: str,
    subject: str,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Pairs of neighbours within ``group`` ordered by (lat, lon, ``row_id``, ``subject``).

    Returns the group columns, ``subject``, ``next_<subject>`` and ``distance_m``. Each
    row meets its successor only, never all rows of the group.

    Groups that fit a task go through one window. A group that holds more than a task's
    share is range-partitioned along its own order into chunks; the window runs inside
    the chunks and the last row of each is paired with the head of the next chunk.
    """
    group = list(group)
    order = ["lat", "lon", row_id, subject]
    rows = df.select(*group, *order)
    hot = hot_keys(rows, group, min_hot_rows)
    if not hot:
        paired = _pair_within(rows, group, order, subject)
    else:
        splits = hot_table(rows, group, hot)
        cold = _pair_within(rows.join(splits, group, "left_anti"), group, order, subject)
        paired = cold.unionByName(
            _pair_across_chunks(rows.join(splits, group, "left_semi"), group, order, subject)
        )
    metres = F.lit(1000.0) * haversine_km(
        F.col("lat"), F.col("lon"), F.col("_next.lat"), F.col("_next.lon")
    )
    return paired.where(F.col("_next").isNotNull()).select(
        *group, subject, F.col(f"_next.{subject}").alias(f"next_{subject}"), metres.alias("distance_m")
    )


def _pair_within(rows: DataFrame, group: list[str], order: list[str], subject: str) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_next", F.lead(F.struct("lat", "lon", subject)).over(ordered))


def _pair_across_chunks(
    rows: DataFrame, group: list[str], order: list[str], subject: str
) -> DataFrame:
    # The chunk number is read twice, for the rows and for the heads. It is written to
    # the shared folder once, so that a lost executor cannot move the chunk borders.
    ranges = rows.repartitionByRange(task_count(rows), *group, *order)
    chunks = staged(
        ranges.withColumn("_chunk", F.spark_partition_id()), scratch_path(rows.sparkSession, "chunks")
    )
    heads = chunks.groupBy(*group, "_chunk").agg(
        F.min(F.struct(*order)).alias("_head")
    )
    # At most one head per chunk, plus one per hot group.
    next_heads = heads.withColumn(
        "_next_head", F.lead("_head").over(Window.partitionBy(*group).orderBy("_chunk"))
    ).select(
        *group,
        "_chunk",
        F.when(
            F.col("_next_head").isNotNull(),
            F.struct("_next_head.lat", "_next_head.lon", f"_next_head.{subject}"),
        ).alias("_next_head"),
    )
    inside = _pair_within(chunks, [*group, "_chunk"], order, subject)
    return (
        inside.join(F.broadcast(next_heads), [*group, "_chunk"], "left")
        .withColumn("_next", F.coalesce("_next", "_next_head"))
        .select(*rows.columns, "_next")
    )
