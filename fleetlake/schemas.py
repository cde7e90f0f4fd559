"""Table schemas, natural keys and landed-snapshot schemas.

Every reader in the package uses these; nothing is inferred from files.
"""

from __future__ import annotations

from pyspark.sql import types as T

_NTZ = T.TimestampNTZType()

POSITIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("collected_at", _NTZ, False),
        T.StructField("vehicle_id", T.LongType(), False),
        T.StructField("line_code", T.StringType()),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
        T.StructField("position_at", _NTZ),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("collected_at", _NTZ, False),
        T.StructField("line_id", T.LongType(), False),
        T.StructField("vehicle_id", T.LongType(), False),
        T.StructField("stop_id", T.LongType()),
        T.StructField("predicted_at", T.StringType()),
    ]
)

FLEET_STATUS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("analyzed_at", _NTZ, False),
        T.StructField("vehicle_id", T.LongType(), False),
        T.StructField("line_code", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("position_at", _NTZ),
        T.StructField("next_stop_id", T.LongType()),
        T.StructField("predicted_arrival", T.StringType()),
    ]
)

LINEAGE_AUDIT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("asset_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("run_timestamp", _NTZ, False),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

LINE_CATALOG = T.StructType(
    [
        T.StructField("line_id", T.LongType()),
        T.StructField("line_number", T.StringType()),
        T.StructField("line_suffix", T.LongType()),
        T.StructField("outbound_name", T.StringType()),
        T.StructField("return_name", T.StringType()),
    ]
)

EXTERNAL_TIMES = T.StructType(
    [T.StructField("ord", T.IntegerType(), False), T.StructField("ref_at", _NTZ, False)]
)

# Headerless, pipe-delimited report files.
COMPLETENESS_REPORT = T.StructType(
    [
        T.StructField("line_code", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("prediction_share", T.DoubleType()),
    ]
)
CENTROID_REPORT = T.StructType(
    [
        T.StructField("line_code", T.StringType()),
        T.StructField("avg_lat", T.DoubleType()),
        T.StructField("avg_lon", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
)

# Landed snapshots: one JSON document per line of a file. The vehicle and stop codes
# arrive as numbers or as quoted numbers, so they are read as text and cast. The
# collection time (and the line id of a prediction request) is stamped by whoever
# lands the file.
POSITION_SNAPSHOT = (
    "collected_at STRING, _corrupt_record STRING, "
    "l ARRAY<STRUCT<c: STRING, "
    "vs: ARRAY<STRUCT<p: STRING, py: DOUBLE, px: DOUBLE, ta: STRING>>>>"
)
PREDICTION_SNAPSHOT = (
    "collected_at STRING, _corrupt_record STRING, line_id BIGINT, "
    "ps ARRAY<STRUCT<cp: STRING, vs: ARRAY<STRUCT<p: STRING, t: STRING>>>>"
)

POSITIONS_KEY = ["collected_at", "vehicle_id"]
PREDICTIONS_KEY = ["collected_at", "line_id", "vehicle_id", "stop_id", "predicted_at"]

TABLES = {
    "positions": POSITIONS,
    "predictions": PREDICTIONS,
    "fleet_status": FLEET_STATUS,
    "lineage_audit": LINEAGE_AUDIT,
}
NATURAL_KEYS = {"positions": POSITIONS_KEY, "predictions": PREDICTIONS_KEY}

# Time column the ``dt`` partition of a table is taken from.
TIME_COLUMN = {
    "positions": "collected_at",
    "predictions": "collected_at",
    "fleet_status": "analyzed_at",
    "lineage_audit": "run_timestamp",
}


def partitioned(schema: T.StructType) -> T.StructType:
    """``schema`` as it lies on disk: with the ``dt`` partition column."""
    return T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
