"""Collection times against reference times of another source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import minutes_between
from fleetlake.operators.quantiles import exact_quantiles

# Fixed value: a gap above this many minutes means that collections were lost.
LOSS_MINUTES = 10


def nearest_by_hour(references: DataFrame) -> DataFrame:
    """For each of the 24 hours the reference nearest by hour of day; first wins ties.

    Matching through this 24-row table replaces comparing every row with every
    reference, whatever the number of either.
    """
    distance = F.abs(F.hour("ref_at") - F.col("our_hour"))
    return (
        references.select("ord", "ref_at", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("our_hour"))
        .groupBy("our_hour")
        .agg(F.min(F.struct(distance.alias("distance"), "ord", "ref_at")).alias("nearest"))
        .select("our_hour", F.col("nearest.ref_at").alias("ref_at"))
    )


def external_time_match(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Every row with the reference time nearest to its collection by hour of day."""
    hours = F.broadcast(nearest_by_hour(references))
    return (
        rows.withColumn("our_hour", F.hour("collected_at"))
        .join(hours, "our_hour")
        .withColumn("ref_hour", F.hour("ref_at"))
    )


def external_gap_stats(matched: DataFrame, loss_minutes: float = LOSS_MINUTES) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the gap in minutes.

    The quartiles are interpolated and exact; they come from ranges of the ordered gaps,
    whatever their number.
    """
    gaps = matched.select(F.abs(minutes_between(F.col("ref_at"), F.col("collected_at"))).alias("g"))
    g = F.col("g")
    quartiles = [F.lit(q).cast("double") for q in exact_quantiles(gaps, "g", (0.25, 0.5, 0.75))]
    return gaps.agg(
        F.count(g).alias("n"),
        F.round(F.avg(g), 6).alias("mean"),
        F.round(F.stddev_samp(g), 6).alias("std"),
        F.min(g).alias("min"),
        *[F.round(q, 6).alias(name) for q, name in zip(quartiles, ("p25", "p50", "p75"), strict=True)],
        F.max(g).alias("max"),
        F.count_if(g > loss_minutes).alias("over_10"),
    )
