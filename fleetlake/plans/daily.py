"""The daily chain per table: collect, compact, reconcile, purge; each step is audited."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import contracts
from fleetlake.operators.quality import freshness, last_batch, reconcile
from fleetlake.plans.append import idempotent_append
from fleetlake.plans.compaction import compact, verify_day
from fleetlake.plans.digests import Archive
from fleetlake.plans.lineage import record_run
from fleetlake.plans.retention import KEEP_DAYS, cutoff, purge
from fleetlake.session import scratch_path, staged
from fleetlake.sources import snapshots
from fleetlake.sources.layers import Lake, read_newest_day, read_table
from fleetlake.sources.paths import remove

RULES = {"positions": contracts.position_rules, "predictions": contracts.prediction_rules}


def audit_path(lake: Lake) -> str:
    return lake.path("audit", "lineage_audit")


def quarantine_path(lake: Lake, table: str, run: str) -> str:
    """A folder per run, so that repeating a run replaces its rejects."""
    return f"{lake.path('quarantine', table)}/run={run}"


def store_batch(
    spark: SparkSession,
    lake: Lake,
    table: str,
    rows: DataFrame,
    run: str,
    documents: DataFrame | None = None,
    aside: str | None = None,
) -> dict[str, int]:
    """Take one staged batch of flat rows into bronze; what is refused goes to quarantine.

    With ``aside`` the rows to add are written to that folder and left for the caller to publish.

    The contract comes first, so a row without a readable time is refused with its reason
    and not taken for one outside the hours. Returns what became of the rows: ``landed``,
    ``added``, ``duplicates``, ``outside_hours``, ``quarantined``.
    """
    rules = contracts.landed_rules(RULES[table]())
    valid = contracts.accepted(rows, rules)
    open_ = snapshots.in_hours("collected_at") if table == "positions" else F.lit(True)
    good = contracts.is_valid(rules)
    landed, kept, outside = rows.agg(
        F.count("*"), F.count_if(good & open_), F.count_if(good & ~open_)
    ).first()
    added = idempotent_append(
        valid.where(open_),
        lake.path("bronze", table),
        table,
        ["ordinal"],
        quarantine_path(lake, table, f"{run}-incomplete"),
        aside,
    )
    contracts.rejects(rows, rules).write.mode("overwrite").parquet(quarantine_path(lake, table, run))
    if documents is not None:
        documents.write.mode("overwrite").parquet(f"{lake.path('quarantine', 'documents')}/{table}/run={run}")
    return {
        "landed": landed,
        "added": added,
        "duplicates": kept - added,
        "outside_hours": outside,
        "quarantined": landed - kept - outside,
    }


def collect(
    spark: SparkSession,
    lake: Lake,
    table: str,
    rows: DataFrame,
    as_of: datetime,
    documents: DataFrame | None = None,
) -> int:
    """Store the valid rows of a landed batch in bronze; rejects go to quarantine.

    Returns the rows added, which are also what the audit counts. The batch is parsed once
    and staged, because it is read for its valid rows and its rejects.
    """
    path = scratch_path(spark, f"batch_{table}")
    try:
        done = store_batch(spark, lake, table, staged(rows, path), f"{as_of:%Y%m%dT%H%M%S}", documents)
    finally:
        remove(spark, path)
    record_run(spark, audit_path(lake), f"collect_{table}", table, "bronze", done["added"], "ok", as_of)
    return done["added"]


def collect_positions(
    spark: SparkSession,
    lake: Lake,
    landing: str,
    as_of: datetime,
    catalog: DataFrame,
    target_ids: list[int],
) -> int:
    codes = snapshots.target_codes(catalog, target_ids)
    landed = snapshots.read_position_snapshots(spark, landing, whole_files=True)
    rows = snapshots.flatten_positions(landed, codes)
    return collect(spark, lake, "positions", rows, as_of, snapshots.unreadable_documents(landed))


def collect_predictions(spark: SparkSession, lake: Lake, landing: str, as_of: datetime) -> int:
    landed = snapshots.read_prediction_snapshots(spark, landing, whole_files=True)
    rows = snapshots.flatten_predictions(landed)
    return collect(spark, lake, "predictions", rows, as_of, snapshots.unreadable_documents(landed))


def _merge(archive: Archive, days: list[str]) -> int:
    """Merge days of bronze into silver; returns the rows that silver gained."""
    rows = read_table(archive.spark, archive.paths["bronze"], archive.table)
    compact(rows.where(F.col("dt").isin(days)), archive.paths["silver"], archive.table)
    return archive.compacted(days)


def compact_day(spark: SparkSession, lake: Lake, table: str, day: date, as_of: datetime) -> int:
    """Copy one day of bronze to silver; returns what the silver partition then holds.

    A day that silver is known to hold is not read.
    """
    archive, name = Archive(spark, lake, table), day.isoformat()
    if name not in archive.days:
        return 0
    if archive.lacking([name]):
        _merge(archive, [name])
    archive.save()
    total = verify_day(spark, archive.paths["silver"], table, day)
    if total:
        record_run(spark, audit_path(lake), f"compact_{table}", table, "silver", total, "ok", as_of)
    return total


def compact_changed(
    spark: SparkSession, lake: Lake, table: str, as_of: datetime, archive: Archive | None = None
) -> int:
    """Take every day of bronze into silver that has rows silver lacks; returns how many rows were lacking.

    Rows that reach an older day late are found this way. Days whose files are those of the
    last run are not read; see ``plans/digests.py``. A caller that hands in ``archive`` saves it.
    """
    alone, archive = archive is None, archive or Archive(spark, lake, table)
    lacking = archive.lacking()
    total = _merge(archive, sorted(lacking)) if lacking else 0
    if alone:
        archive.save()
    if total:
        record_run(spark, audit_path(lake), f"compact_{table}", table, "silver", total, "ok", as_of)
    return total


def check_layers(
    spark: SparkSession, lake: Lake, table: str, as_of: datetime, by_day: bool = True
) -> DataFrame:
    """Compare bronze with silver; a difference is recorded as an alert and stops nothing."""
    result = reconcile(
        read_table(spark, lake.path("bronze", table), table),
        read_table(spark, lake.path("silver", table), table),
        by_day,
    )
    failed = result.where(~F.col("passed")).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    status = "alert" if failed else "ok"
    record_run(spark, audit_path(lake), f"reconcile_{table}", table, "silver", failed, status, as_of)
    return result


def check_health(spark: SparkSession, lake: Lake, as_of: datetime) -> DataFrame:
    """Per bronze table: is it empty, is it stale, and the size of its last batch.

    Reads the newest day of each table only.
    """
    newest = {t: read_newest_day(spark, lake.path("bronze", t), t) for t in RULES}
    return freshness(newest, as_of).join(last_batch(newest), "table_name")


def purge_table(
    spark: SparkSession, lake: Lake, table: str, as_of: datetime, keep_days: int = KEEP_DAYS
) -> int:
    """Drop what left the hot window, after bringing silver up to date.

    A day of which silver still lacks a row stays.
    """
    archive = Archive(spark, lake, table)
    compact_changed(spark, lake, table, as_of, archive)
    removed = purge(
        spark,
        archive.paths["bronze"],
        table,
        cutoff(as_of, keep_days),
        archived={day for day in archive.days if archive.is_proven(day)},
    )
    if removed:
        archive.purged()
    archive.save()
    if removed:
        record_run(spark, audit_path(lake), f"purge_{table}", table, "bronze", removed, "ok", as_of)
    return removed


def run_daily(
    spark: SparkSession,
    lake: Lake,
    day: date,
    as_of: datetime,
    position_landing: str,
    prediction_landing: str,
    catalog: DataFrame,
    target_ids: list[int],
    keep_days: int = KEEP_DAYS,
) -> dict[str, dict[str, int]]:
    """All steps in order for both tables; returns the rows each step touched.

    ``compacted`` counts what silver then holds of ``day``, ``late`` what it lacked of any
    other day.
    """
    done = {
        "positions": {
            "collected": collect_positions(spark, lake, position_landing, as_of, catalog, target_ids)
        },
        "predictions": {"collected": collect_predictions(spark, lake, prediction_landing, as_of)},
    }
    for table, steps in done.items():
        steps["compacted"] = compact_day(spark, lake, table, day, as_of)
        steps["late"] = compact_changed(spark, lake, table, as_of)
        check_layers(spark, lake, table, as_of)
        steps["purged"] = purge_table(spark, lake, table, as_of, keep_days)
    return done
