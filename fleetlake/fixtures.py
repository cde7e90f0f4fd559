"""Fleet-shaped tables derived from an ``events`` table, for tests and benchmarks.

They plant the edge cases the operators must handle: missing line codes, GPS times,
stops and predicted times, vehicles without predictions, vehicles that hardly move,
duplicate predictions, and catalogue lines without a return name.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.operators.fleet import fleet_status as build_fleet_status
from fleetlake.operators.reports import with_period

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Vehicles per snapshot document in the nested fixtures.
DOCUMENT_ROWS = 16


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def positions(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_id as id",
        "cast(date_trunc('hour', ts) as timestamp_ntz) as collected_at",
        "user_id + 1 as vehicle_id",
        "case when event_id % 97 <> 0 then event_type || '-' || cast(10 + user_id % 3 as string) end as line_code",
        "-23.54d - cast(case when user_id % 10 = 0 then user_id * 7 + event_id % 3 "
        "else event_id * 37 + user_id * 11 end % 400 as double) / 1e4d as lat",
        "-46.62d - cast(case when user_id % 10 = 0 then user_id * 3 "
        "else event_id * 13 + user_id * 7 end % 400 as double) / 1e4d as lon",
        "case when event_id % 89 <> 0 then ts end as position_at",
    )


def predictions(ev: DataFrame) -> DataFrame:
    return ev.where("event_id % 2 = 0 and user_id % 5 <> 0").selectExpr(
        "event_id as id",
        "cast(date_trunc('hour', ts) as timestamp_ntz) as collected_at",
        "1000 + user_id % 7 as line_id",
        "user_id + 1 as vehicle_id",
        "case when event_id % 83 <> 0 then 5000 + event_id % 41 end as stop_id",
        "case when event_id % 79 <> 0 then lpad(cast(event_id * 7 % 24 as string), 2, '0') || ':' "
        "|| lpad(cast(event_id * 11 % 60 as string), 2, '0') end as predicted_at",
    )


def prediction_copies(ev: DataFrame) -> DataFrame:
    """Copies of every third prediction under later ids."""
    return (
        predictions(ev)
        .where(F.col("id") % 3 == 0)
        .withColumn("id", F.col("id") + F.lit(1_000_000_000))
    )


def predictions_dup(ev: DataFrame) -> DataFrame:
    return predictions(ev).unionByName(prediction_copies(ev))


def line_catalog(ev: DataFrame) -> DataFrame:
    """The lines that occur, numbered in order. A handful of rows."""
    lines = ev.select("event_type", (10 + F.col("user_id") % 3).alias("line_suffix")).distinct()
    # The place in the sorted list of lines, which is small, numbers them.
    listed = lines.agg(F.sort_array(F.collect_set(F.struct("event_type", "line_suffix"))).alias("all"))
    numbered = listed.select(F.posexplode("all").alias("place", "line"))
    return numbered.select(
        (F.col("place") + 1).cast("bigint").alias("line_id"),
        F.col("line.event_type").alias("line_number"),
        F.col("line.line_suffix").alias("line_suffix"),
        F.concat(F.lit("Terminal "), F.upper("line.event_type")).alias("outbound_name"),
        F.when(
            F.col("line.line_suffix") != 12,
            F.concat(F.lit("Bairro "), F.col("line.line_suffix").cast("string")),
        ).alias("return_name"),
    )


def fleet_status(ev: DataFrame) -> DataFrame:
    return build_fleet_status(positions(ev), predictions(ev))


def vehicle_track(ev: DataFrame) -> DataFrame:
    """Fleet status for questions that read no prediction column."""
    return build_fleet_status(positions(ev), None)


def lineage_audit(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_id as id",
        "'compact_' || event_type as asset_name",
        "event_type as table_name",
        "case when user_id % 2 = 0 then 'bronze' else 'silver' end as layer",
        "ts as run_timestamp",
        "user_id * 10 as row_count",
        "case when event_id % 10 = 0 then 'alert' else 'ok' end as status",
    )


def external_times(spark: SparkSession) -> DataFrame:
    hours = (5, 12, 21)
    rows = [(i + 1, datetime(2024, 1, 15, hour)) for i, hour in enumerate(hours)]
    return spark.createDataFrame(rows, schemas.EXTERNAL_TIMES)


def delays(ev: DataFrame) -> DataFrame:
    usable = positions(ev).dropna(subset=["line_code", "position_at"])
    return with_period(usable).select(
        "id", "line_code", "period", "day", (F.col("id") % 20).cast("double").alias("delay_min")
    )


def position_snapshots(ev: DataFrame) -> DataFrame:
    """Positions nested as the API delivers them, a line per document.

    A document holds vehicles from a run of ``DOCUMENT_ROWS`` consecutive ids, so no
    group grows with the data.
    """
    vehicle = F.struct(
        F.col("vehicle_id").cast("string").alias("p"),
        F.col("lat").alias("py"),
        F.col("lon").alias("px"),
        F.date_format("position_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ta"),
    )
    documents = (
        positions(ev)
        .groupBy("collected_at", "line_code", F.floor(F.col("id") / DOCUMENT_ROWS).alias("document"))
        .agg(F.collect_list(vehicle).alias("vs"))
    )
    line = F.struct(F.col("line_code").alias("c"), "vs")
    return documents.select(F.col("collected_at").cast("string"), F.array(line).alias("l"))


def prediction_snapshots(ev: DataFrame) -> DataFrame:
    """Predictions nested per request (line), a stop per document, bounded likewise."""
    arrival = F.struct(
        F.col("vehicle_id").cast("string").alias("p"), F.col("predicted_at").alias("t")
    )
    documents = (
        predictions(ev)
        .groupBy(
            "collected_at", "line_id", "stop_id", F.floor(F.col("id") / DOCUMENT_ROWS).alias("document")
        )
        .agg(F.collect_list(arrival).alias("vs"))
    )
    stop = F.struct(F.col("stop_id").cast("string").alias("cp"), "vs")
    return documents.select(F.col("collected_at").cast("string"), "line_id", F.array(stop).alias("ps"))


def as_json(snapshots: DataFrame) -> DataFrame:
    """One JSON document per row, as landed files hold them."""
    return snapshots.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
