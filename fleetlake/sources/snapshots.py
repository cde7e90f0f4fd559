"""Landed snapshots of the fleet API: nested JSON to flat rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.functions import gps_to_local, parse_local, parse_utc, seconds_of_day
from fleetlake.operators.skew import broadcast_if_small

# Positions are collected from 05:00 to 23:00, both included.
OPENING_SECOND = 5 * 3600
CLOSING_SECOND = 23 * 3600


def read_position_snapshots(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    return _read(spark, path, schemas.POSITION_SNAPSHOT, whole_files)


def read_prediction_snapshots(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    return _read(spark, path, schemas.PREDICTION_SNAPSHOT, whole_files)


def _read(spark: SparkSession, path: str, schema: str, whole_files: bool) -> DataFrame:
    """Landed documents, one per line; with ``whole_files`` also such as fill a file over several lines.

    Files are read by lines first. Only those with a line that is no document are read again as a
    whole, and where all of the text is one document or an array of them, that replaces the lines.
    """
    lines = spark.read.schema(schema).json(path)
    if not whole_files:
        return lines
    named = lines.withColumn("_file", F.col("_metadata.file_path"))
    # Reading the broken text alone is not allowed; the second test is always true.
    broken = F.col("_corrupt_record").isNotNull() & (F.length(F.coalesce("collected_at", F.lit(""))) >= 0)
    # Some of the names that the planner lists for the scan anyway.
    files = [r["_file"] for r in named.where(broken).select("_file").distinct().collect()]
    if not files:
        return lines
    whole = whole_documents(spark, files, schema)
    kept = named.join(whole.select("_file").distinct(), "_file", "left_anti")
    return kept.drop("_file").unionByName(whole.drop("_file"), allowMissingColumns=True).select(*lines.columns)


def whole_documents(spark: SparkSession, files: list[str], schema: str) -> DataFrame:
    """``_file`` and the documents of files that hold one, or an array of them, as their whole text."""
    # Spark names files as URLs but takes paths, in which some characters stand for patterns.
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file)) for file in files]
    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), "value")
    # The parser passes over what follows a document. No text that goes on after one fits into both frames.
    framed = [F.try_parse_json(F.concat(F.lit(a), "value", F.lit(b))) for a, b in (("[", "]"), ('{"a":', "}"))]
    parsed = texts.where(framed[0].isNotNull() & framed[1].isNotNull())
    one = F.array(F.from_json("value", schema))
    several = F.from_json("value", f"array<struct<{_as_fields(schema)}>>")
    listed = F.when(F.ltrim("value").startswith("["), several).otherwise(one)
    documents = parsed.select("_file", F.explode(listed).alias("document"))
    return documents.select("_file", "document.*").where("collected_at is not null and _corrupt_record is null")


def _as_fields(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))


def unreadable_documents(snapshots: DataFrame) -> DataFrame:
    """``document, reason`` of landed lines that are no snapshot: broken JSON, or no collection time.

    A document written over several lines shows up here line by line, unless it was read
    with ``whole_files``.
    """
    reason = F.when(F.col("_corrupt_record").isNotNull(), "broken").when(
        F.col("collected_at").isNull(), "no collection time"
    )
    document = F.coalesce("_corrupt_record", F.to_json(F.struct(*[c for c in snapshots.columns if c != "_corrupt_record"])))
    return snapshots.select(document.alias("document"), reason.alias("reason")).where("reason is not null")


def delivered(snapshots: DataFrame, outer: str, inner: str = "vs") -> DataFrame:
    """``collected_at, delivered``: how many vehicles each document brought."""
    sizes = F.transform(F.coalesce(F.col(outer), F.array()), lambda x: F.greatest(F.size(x[inner]), F.lit(0)))
    return snapshots.select(
        parse_local(F.col("collected_at")).alias("collected_at"),
        F.aggregate(sizes, F.lit(0), lambda a, b: a + b).cast("long").alias("delivered"),
    )


def flatten_positions(
    snapshots: DataFrame,
    codes: DataFrame | None = None,
    gps_zone: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per vehicle of every line, stamped with the collection time.

    Lines without vehicles and snapshots without lines give nothing. The line filter
    runs before the vehicles are unfolded. ``ordinal`` is the place in the document.
    GPS times are UTC unless ``gps_zone`` asks for local ones. ``unreadable`` names the
    optional field whose text could not be read, else it is NULL. Columns named in
    ``carry`` are taken along from the document.
    """
    document = ["collected_at", *carry]
    lines = snapshots.select(*document, F.posexplode("l").alias("line_pos", "line")).select(
        *document, "line_pos", F.col("line.c").alias("line_code"), F.col("line.vs").alias("vs")
    )
    if codes is not None:
        lines = filter_target_lines(lines, codes)
    vehicles = lines.select(
        *document, "line_code", "line_pos", F.posexplode("vs").alias("vehicle_pos", "v")
    )
    gps_time = parse_utc(F.col("v.ta"))
    return vehicles.select(
        _ordinal("line_pos"),
        parse_local(F.col("collected_at")).alias("collected_at"),
        F.col("v.p").try_cast("bigint").alias("vehicle_id"),
        "line_code",
        F.col("v.py").alias("lat"),
        F.col("v.px").alias("lon"),
        (gps_to_local(gps_time, gps_zone) if gps_zone else gps_time).alias("position_at"),
        _unreadable(F.col("v.ta"), gps_time, "position_at"),
        *carry,
    )


def flatten_predictions(snapshots: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per stop and vehicle, with the line the request was for."""
    document = ["collected_at", "line_id", *carry]
    stops = snapshots.select(*document, F.posexplode("ps").alias("stop_pos", "stop"))
    vehicles = stops.select(
        *document,
        "stop_pos",
        F.col("stop.cp").alias("stop"),
        F.posexplode("stop.vs").alias("vehicle_pos", "v"),
    )
    return vehicles.select(
        _ordinal("stop_pos"),
        parse_local(F.col("collected_at")).alias("collected_at"),
        "line_id",
        F.col("v.p").try_cast("bigint").alias("vehicle_id"),
        F.col("stop").try_cast("bigint").alias("stop_id"),
        F.col("v.t").alias("predicted_at"),
        _unreadable(F.col("stop"), F.col("stop").try_cast("bigint"), "stop_id"),
        *carry,
    )


def _unreadable(text: Column, value: Column, name: str) -> Column:
    return F.when((F.trim(text) != "") & value.isNull(), F.lit(name)).alias("unreadable")


def _ordinal(outer: str):
    return (F.shiftleft(F.col(outer).cast("bigint"), 32) + F.col("vehicle_pos")).alias("ordinal")


def target_codes(catalog: DataFrame, target_ids: list[int]) -> DataFrame:
    """Codes ``number-suffix`` of the catalogue lines with the given ids."""
    return (
        catalog.where(F.col("line_id").isin(target_ids))
        .select(
            F.concat(
                F.col("line_number").cast("string"), F.lit("-"), F.col("line_suffix").cast("string")
            ).alias("line_code")
        )
        .where(F.col("line_code").isNotNull())
        .distinct()
    )


def filter_target_lines(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows whose line is one of ``codes``.

    The code set is broadcast once its measured size allows it, so that a busy line is
    filtered where it is read; a larger set joins by shuffle.
    """
    return rows.join(broadcast_if_small(codes), "line_code", "left_semi")


def operating_hours(rows: DataFrame, time: str = "position_at") -> DataFrame:
    """Rows whose time of day lies in the collection hours; rows without a time do not."""
    return rows.where(in_hours(time))


def in_hours(time: str) -> Column:
    """Whether the time of day lies in the collection hours; NULL without a time."""
    return seconds_of_day(F.col(time)).between(OPENING_SECOND, CLOSING_SECOND)
