"""Fleet status and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import haversine_km, line_number, line_suffix, minutes_between
from fleetlake.operators.bunching import adjacent_distances
from fleetlake.operators.pick import first_per_key, last_per_key
from fleetlake.operators.skew import MIN_HOT_ROWS, left_join_unique

# A vehicle is stuck after more than 10 minutes within less than 0.1 km;
# two neighbours closer than 200 m are bunched.
STUCK_MINUTES = 10
STUCK_KM = 0.1
BUNCHED_METRES = 200


def first_prediction(predictions: DataFrame, last_snapshot_only: bool = False) -> DataFrame:
    """Earliest predicted arrival per vehicle; the text sorts as text, NULL last."""
    if last_snapshot_only:
        newest = predictions.agg(F.max("collected_at")).scalar()
        predictions = predictions.where(F.col("collected_at") == newest)
    return first_per_key(
        predictions,
        ["vehicle_id"],
        [F.col("predicted_at").isNull(), "predicted_at", "collected_at", "id"],
        ["stop_id", "predicted_at"],
    )


def fleet_status(
    positions: DataFrame, predictions: DataFrame | None, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Every position with its vehicle's first prediction.

    Without predictions the prediction columns are NULL. ``analyzed_at`` is the time of
    the snapshot the position came with.
    """
    status = positions.select(
        "id",
        F.col("collected_at").alias("analyzed_at"),
        "vehicle_id",
        "line_code",
        "lat",
        "lon",
        "position_at",
    )
    if predictions is None:
        return status.select(
            "*",
            F.lit(None).cast("bigint").alias("next_stop_id"),
            F.lit(None).cast("string").alias("predicted_arrival"),
        )
    upcoming = first_prediction(predictions).withColumnsRenamed(
        {"stop_id": "next_stop_id", "predicted_at": "predicted_arrival"}
    )
    joined = left_join_unique(status, upcoming, ["vehicle_id"], ["analyzed_at", "id"], min_hot_rows)
    return joined.select(*status.columns, "next_stop_id", "predicted_arrival")


def latest_position(
    status: DataFrame, line_code: str | None = None, unique_times: bool = False
) -> DataFrame:
    """Last known place per vehicle, of one line if given.

    Vehicles whose last row has no coordinates drop out; an older row does not stand in.
    ``unique_times`` promises one row per vehicle and time, as the lake's natural key
    gives, and saves ordering by id.
    """
    if line_code is not None:
        status = status.where(F.col("line_code") == line_code)
    order = ["analyzed_at"] if unique_times else ["analyzed_at", "id"]
    last = last_per_key(status, ["vehicle_id"], order, ["lat", "lon"], unique_times)
    return last.dropna(subset=["lat", "lon"])


def stuck_vehicles(
    status: DataFrame,
    min_minutes: float = STUCK_MINUTES,
    max_km: float = STUCK_KM,
    unique_times: bool = False,
) -> DataFrame:
    """Vehicles seen for longer than ``min_minutes`` that ended within ``max_km`` of their start.

    The line is that of the first row that names one. One pass, and one shuffle of a row
    per vehicle and map task. ``unique_times`` as in :func:`latest_position`.
    """
    track = _hashed_track(status) if unique_times else _track(status)
    measured = track.select(
        "vehicle_id",
        F.col("named.line_code").alias("line_code"),
        minutes_between(F.col("first.analyzed_at"), F.col("last.analyzed_at")).alias("elapsed_min"),
        haversine_km(
            F.col("first.lat"), F.col("first.lon"), F.col("last.lat"), F.col("last.lon")
        ).alias("distance_km"),
    )
    return measured.where((F.col("elapsed_min") > min_minutes) & (F.col("distance_km") < max_km))


def _track(status: DataFrame) -> DataFrame:
    """First row, last row and first named line per vehicle."""
    seen = F.struct("analyzed_at", "id", "lat", "lon")
    named = F.struct("analyzed_at", "id", "line_code")
    return status.groupBy("vehicle_id").agg(
        F.min(seen).alias("first"),
        F.max(seen).alias("last"),
        F.min(F.when(F.col("line_code").isNotNull(), named)).alias("named"),
    )


def _hashed_track(status: DataFrame) -> DataFrame:
    """The same where a vehicle's times are unique.

    The large step groups by vehicle and line on fixed-width values, which hashes; the
    structs are built from its result, a few rows per vehicle.
    """
    time = "analyzed_at"
    per_line = status.groupBy("vehicle_id", "line_code").agg(
        F.min(time).alias("t0"),
        F.max(time).alias("t1"),
        *[F.min_by(c, time).alias(f"first_{c}") for c in ("lat", "lon")],
        *[F.max_by(c, time).alias(f"last_{c}") for c in ("lat", "lon")],
    )

    def seen(when: str, end: str):
        return F.struct(
            F.col(when).alias(time), F.col(f"{end}_lat").alias("lat"), F.col(f"{end}_lon").alias("lon")
        )

    named = F.struct(F.col("t0").alias(time), "line_code")
    return per_line.groupBy("vehicle_id").agg(
        F.min(seen("t0", "first")).alias("first"),
        F.max(seen("t1", "last")).alias("last"),
        F.min(F.when(F.col("line_code").isNotNull(), named)).alias("named"),
    )


def bunched_events(
    status: DataFrame, max_metres: float = BUNCHED_METRES, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Neighbours by latitude, in one line and snapshot, that are closer than ``max_metres``."""
    usable = status.dropna(subset=["analyzed_at", "line_code", "lat", "lon"])
    pairs = adjacent_distances(
        usable, ["analyzed_at", "line_code"], "id", "vehicle_id", min_hot_rows
    )
    return pairs.where(F.col("distance_m") < max_metres)


def count_by_line(found: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows per line, busiest first; rows without a line are left out.

    ``ordered=False`` is for callers that sort later.
    """
    counts = (
        found.where(F.col("line_code").isNotNull())
        .groupBy("line_code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.orderBy(F.desc("n"), "line_code") if ordered else counts


def enrich_line_names(
    lines: DataFrame, catalog: DataFrame | None, busiest_first: bool = True
) -> DataFrame:
    """Add ``line_name``: both terminals from the catalogue, or the code itself.

    A NULL terminal makes the name NULL and so falls back too. Both sides hold a row
    per line; the planner picks the join from their sizes. A join keeps no order, so counts
    are sorted after it.
    """
    ordered = [F.desc("n"), F.col("line_code")] if busiest_first and "n" in lines.columns else []
    if catalog is None:
        named = lines.withColumn("line_name", F.col("line_code"))
        return named.orderBy(*ordered) if ordered else named
    names = catalog.select(
        F.col("line_number").cast("string").alias("_number"),
        F.col("line_suffix").cast("bigint").alias("_suffix"),
        F.concat("outbound_name", F.lit(" / "), "return_name").alias("_name"),
    )
    code = F.col("line_code")
    same_line = (line_number(code) == F.col("_number")) & (line_suffix(code) == F.col("_suffix"))
    named = lines.join(names, same_line, "left").select(
        *lines.columns, F.coalesce("_name", "line_code").alias("line_name")
    )
    return named.orderBy(*ordered) if ordered else named


def line_list(status: DataFrame) -> DataFrame:
    """The lines present, sorted."""
    return (
        status.where(F.col("line_code").isNotNull()).select("line_code").distinct().orderBy("line_code")
    )


def fleet_kpis(status: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Rows, distinct lines and bunching events, in one row.

    Rows are counted per line first, so that the distinct count runs over lines.
    """
    per_line = status.groupBy("line_code").agg(F.count(F.lit(1)).alias("rows"))
    totals = per_line.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("line_code").alias("lines"),
        F.lit(None).cast("bigint").alias("bunching_events"),
    )
    events = bunched_events(status, min_hot_rows=min_hot_rows).agg(
        F.lit(None).cast("bigint").alias("total_rows"),
        F.lit(None).cast("bigint").alias("lines"),
        F.count(F.lit(1)).alias("bunching_events"),
    )
    return totals.unionByName(events).agg(
        *[F.max(c).alias(c) for c in ("total_rows", "lines", "bunching_events")]
    )
