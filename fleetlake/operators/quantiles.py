"""Exact quantiles of any number of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import scratch_path, staged


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of the values that are not NULL; None for each if there are none.

    Equal values are counted before the shuffle. The distinct ones are ordered by ranges, so
    that a rank is the total of the ranges before, one number per partition, and a running
    sum inside one. No task sees more than its range.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("v").withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, scratch_path(df.sparkSession, "ranges"))
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    total = sum(r["n"] for r in totals)
    if not total:
        return [None] * len(shares)
    before, offsets = 0, []
    for row in totals:
        offsets.append((row["part"], before))
        before += row["n"]
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "part int, start long"))
    inside = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, "part")
    first = F.col("start") + F.col("own")
    places = sorted({k for s in shares for k in (math.floor(s * (total - 1)), math.ceil(s * (total - 1)))})
    found = ranked.agg(
        *[F.max(F.when((first <= k) & (k < first + F.col("n")), F.col("v"))).alias(str(k)) for k in places]
    ).first()
    out = []
    for share in shares:
        place = share * (total - 1)
        low, high = found[str(math.floor(place))], found[str(math.ceil(place))]
        out.append(low + (high - low) * (place - math.floor(place)))
    return out
