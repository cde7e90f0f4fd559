"""Per-line reports and listings. Aggregations combine before their shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import day_period, region_of

TOP_LINES = 20
RECENT_ROWS = 50
SAMPLE_ROWS = 10


def _known_line(status: DataFrame) -> DataFrame:
    return status.where(F.col("line_code").isNotNull())


def top_lines_by_volume(status: DataFrame, k: int = TOP_LINES) -> DataFrame:
    """Busiest lines with their rows and the rows that have a prediction; NULL is a line."""
    return (
        status.groupBy("line_code")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count("next_stop_id").alias("with_prediction"),
        )
        .orderBy(F.desc("total"), F.asc_nulls_last("line_code"))
        .limit(k)
    )


def prediction_completeness(status: DataFrame) -> DataFrame:
    """Percent of each line's rows that have a prediction."""
    return (
        _known_line(status)
        .groupBy("line_code")
        .agg(F.count(F.lit(1)).alias("n"), F.count("next_stop_id").alias("with_stop"))
        .select(
            "line_code",
            "n",
            F.round(F.lit(100.0) * F.col("with_stop") / F.col("n"), 6).alias("completeness_pct"),
        )
    )


def centroids(status: DataFrame, keys: Sequence[str] = ("line_code",)) -> DataFrame:
    """Mean place and row count per key; rows without a key are left out."""
    return (
        status.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            F.avg("lat").alias("avg_lat"),
            F.avg("lon").alias("avg_lon"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def rounded_centroids(status: DataFrame, keys: Sequence[str] = ("line_code",)) -> DataFrame:
    return _rounded(centroids(status, keys))


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumns({c: F.round(c, 6) for c in ("avg_lat", "avg_lon")})


def region_estimate(status: DataFrame, keys: Sequence[str] = ("line_code",)) -> DataFrame:
    """Centroid per key and the region it lies in, decided before rounding."""
    return _rounded(
        centroids(status, keys).withColumn("region", region_of(F.col("avg_lat"), F.col("avg_lon")))
    )


def trusted_line_metrics(status: DataFrame) -> DataFrame:
    """Centroids over the rows in which nothing is missing."""
    return rounded_centroids(
        status.dropna(
            subset=["line_code", "lat", "lon", "position_at", "next_stop_id", "predicted_arrival"]
        )
    )


def one_line(report: DataFrame, line_code: str) -> DataFrame:
    """The entry of one line in a per-line report."""
    return report.where(F.col("line_code") == line_code).limit(1)


def sample_with_prediction(status: DataFrame, k: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows that have a prediction."""
    return (
        status.where(F.col("next_stop_id").isNotNull())
        .orderBy("analyzed_at", "id")
        .limit(k)
        .select("analyzed_at", "vehicle_id", "line_code", "next_stop_id", "predicted_arrival")
    )


def recent_by_line(positions: DataFrame, line_code: str, k: int = RECENT_ROWS) -> DataFrame:
    """Newest positions of a line."""
    return (
        positions.where(F.col("line_code") == line_code)
        .orderBy(F.desc("collected_at"), F.desc("id"))
        .limit(k)
        .select("id", "collected_at", "lat", "lon", "line_code")
    )


def recent_predictions(predictions: DataFrame, line_id: int, k: int = RECENT_ROWS) -> DataFrame:
    """Newest predictions of a line."""
    return (
        predictions.where(F.col("line_id") == line_id)
        .orderBy(F.desc("collected_at"), F.desc("id"))
        .limit(k)
        .select("id", "collected_at", "stop_id", "predicted_at")
    )


def with_period(rows: DataFrame, time: str = "position_at") -> DataFrame:
    """Add ``period`` and ``day`` of a delay measurement."""
    return rows.withColumns({"period": day_period(F.col(time)), "day": F.to_date(time)})


def delay_by_period_line(delays: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Mean delay per period, one column per line, 0 where there is none.

    The lines are given, so the pivot needs no extra job to find its columns.
    """
    pivoted = (
        delays.where(F.col("period").isNotNull())
        .groupBy("period")
        .pivot("line_code", list(lines))
        .agg(F.avg("delay_min"))
        .fillna(0.0)
    )
    return pivoted.withColumnsRenamed({line: line.replace("-", "_") for line in lines})


def delay_kpis(delays: DataFrame) -> DataFrame:
    """Mean delay, worst line and best line; of equal lines the smallest code.

    Everything follows from one sum and count per line; a line without any delay ranks nowhere.
    """
    per_line = delays.groupBy("line_code").agg(
        F.sum("delay_min").alias("s"), F.count("delay_min").alias("c")
    )
    ranked = per_line.where("c > 0").withColumn("d", F.col("s") / F.col("c"))
    return ranked.agg(
        F.round(F.sum("s") / F.sum("c"), 6).alias("mean_delay"),
        F.min_by("line_code", F.struct(-F.col("d"), F.col("line_code"))).alias("worst_line"),
        F.min_by("line_code", F.struct(F.col("d"), F.col("line_code"))).alias("best_line"),
    )


def delay_trend(delays: DataFrame) -> DataFrame:
    """Mean delay per day."""
    return delays.groupBy("day").agg(F.round(F.avg("delay_min"), 6).alias("mean_delay"))


def day_calendar(spark: SparkSession, first: date, days: int) -> DataFrame:
    """``day`` for each of ``days`` calendar days from ``first`` on."""
    start = F.lit(first.isoformat()).cast("date")
    return spark.range(days).select(F.date_add(start, F.col("id").cast("int")).alias("day"))


def delay_trend_over(delays: DataFrame, calendar: DataFrame) -> DataFrame:
    """Mean delay for every day of a calendar, NULL on days without a measurement."""
    return calendar.join(delay_trend(delays), "day", "left")
