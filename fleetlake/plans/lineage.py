"""The audit table: one row per finished step."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators.pick import last_per_key
from fleetlake.plans.append import append

STATUSES = ("ok", "alert", "failed")
RECENT_RUNS = 10

log = logging.getLogger(__name__)


def record_run(
    spark: SparkSession,
    path: str,
    asset_name: str,
    table_name: str,
    layer: str,
    row_count: int = 0,
    status: str = "ok",
    run_timestamp: datetime | None = None,
) -> bool:
    """Append one audit row. A failure is logged and reported, never raised.

    The id is the recording time in microseconds, which orders as a sequence would.
    """
    try:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}")
        now = datetime.now()
        row = (
            int(now.timestamp() * 1_000_000),
            asset_name,
            table_name,
            layer,
            run_timestamp or now,
            row_count,
            status,
        )
        append(spark.createDataFrame([row], schemas.LINEAGE_AUDIT).coalesce(1), path, "lineage_audit")
        return True
    except Exception:
        log.warning("could not record the run of %s on %s/%s", asset_name, layer, table_name, exc_info=True)
        return False


def recent_runs(audit: DataFrame, k: int = RECENT_RUNS) -> DataFrame:
    """The newest audit rows."""
    return (
        audit.orderBy(F.desc("run_timestamp"), F.desc("id"))
        .limit(k)
        .select("asset_name", "layer", "row_count", "status", "run_timestamp")
    )


def last_run_per_asset(audit: DataFrame) -> DataFrame:
    """The newest audit row of every asset."""
    return last_per_key(
        audit,
        ["asset_name"],
        ["run_timestamp", "id"],
        ["layer", "row_count", "status", "run_timestamp"],
    )
