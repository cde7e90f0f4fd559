"""The stored fleet status: positions joined with predictions, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fleetlake.operators.fleet import fleet_status
from fleetlake.plans.append import replace_table
from fleetlake.sources.layers import Lake, load_layer, read_silver


def refresh_fleet_status(spark: SparkSession, lake: Lake, source: str = "silver") -> int:
    """Rebuild the table from ``silver`` (bronze where absent) or from ``bronze``.

    Returns its rows. Without positions the stored table stays as it is.
    """
    if source not in ("silver", "bronze"):
        raise ValueError(f"unknown source {source!r}")
    positions, predictions = (
        load_layer(spark, lake, table)
        if source == "silver"
        else read_silver(spark, lake.path("bronze", table), table)
        for table in ("positions", "predictions")
    )
    if positions.isEmpty():
        return 0
    return replace_table(
        fleet_status(positions, predictions), lake.path("bronze", "fleet_status"), "fleet_status"
    )
