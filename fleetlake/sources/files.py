"""CSV sources: the line catalogue and the delimited reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.sources.paths import exists


def read_catalog(
    spark: SparkSession, path: str, required: bool = True, names: Mapping[str, str] | None = None
) -> DataFrame | None:
    """The line catalogue, a CSV file with a header.

    Columns are taken by the names in ``names`` (header to schema), in any order; a schema
    column that the header lacks is an error. A missing file is an error for a collector
    and None for a report.
    """
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    raw = spark.read.csv(path, header=True)
    renamed = raw.withColumnsRenamed(dict(names or {}))
    missing = [f.name for f in schemas.LINE_CATALOG if f.name not in renamed.columns]
    if missing:
        raise ValueError(f"the header of {path} lacks {missing}")
    return renamed.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.LINE_CATALOG])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|") -> DataFrame:
    """A headerless delimited file; an absent file reads as an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, schema=schema, sep=sep)


def read_completeness_report(spark: SparkSession, path: str) -> DataFrame:
    """Completeness report with its share turned into percent."""
    report = read_delimited(spark, path, schemas.COMPLETENESS_REPORT)
    return report.select(
        "line_code", "n", (F.col("prediction_share") * 100).alias("completeness_pct")
    )


def read_centroid_report(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.CENTROID_REPORT)


def read_line_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Line metrics, a comma-separated file with a header; empty if absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.CENTROID_REPORT)
    return spark.read.csv(path, schema=schemas.CENTROID_REPORT, header=True)


def read_gps_sample(spark: SparkSession, path: str) -> DataFrame:
    """Headerless export of positions whose GPS time is UTC with a zone mark."""
    raw = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.TimestampNTZType() else f.dataType)
            for f in schemas.POSITIONS
        ]
    )
    rows = read_delimited(spark, path, raw)
    return rows.withColumns(
        {c: F.col(c).try_cast("timestamp_ntz") for c in ("collected_at", "position_at")}
    )
