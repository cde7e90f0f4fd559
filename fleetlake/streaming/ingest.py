"""Landed snapshots to the bronze tables with Structured Streaming.

Each micro-batch is flattened and taken into bronze exactly as the batch collector does it, with
the same contract, hours, quarantine and removal of duplicates, and no row is ever late.

A micro-batch goes through five steps, and one that breaks off is run again by Spark under
the same number: (1) its rows are parsed and what is to be added is written aside, with its counts
last; (2) the files are moved into bronze, (3) the counts go to the audit layer, (4) the
number is marked as taken, (5) the folder aside is removed. A step that was finished isn't repeated,
or changes nothing, so each landed row counts once, those with a NULL in the key too.
What is kept for that lies in the checkpoint's folder, one number and one batch at a time, and
leaves with it; nothing grows with the number of batches but the audit.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake import schemas
from fleetlake.plans.append import publish
from fleetlake.plans.daily import store_batch
from fleetlake.session import staged
from fleetlake.sources import snapshots
from fleetlake.sources.layers import Lake
from fleetlake.sources.paths import STAGED, exists, recover, remove, swap_in

SNAPSHOTS = {
    "positions": schemas.POSITION_SNAPSHOT,
    "predictions": schemas.PREDICTION_SNAPSHOT,
}
PROGRESS = (
    "batch bigint, documents bigint, landed bigint, added bigint, duplicates bigint, outside_hours bigint, "
    "quarantined bigint, newest timestamp_ntz"
)


def snapshot_stream(
    spark: SparkSession, landing: str, table: str, max_files: int = 1000
) -> DataFrame:
    """The landing folder as a stream; ``max_files`` only paces a micro-batch."""
    return (
        spark.readStream.schema(SNAPSHOTS[table]).option("maxFilesPerTrigger", max_files).json(landing)
    )


def flat_stream(landed: DataFrame, table: str, codes: DataFrame | None = None) -> DataFrame:
    """Flat rows of a snapshot stream, and a row of only ``document, reason`` for what is none.

    Stateless, so nothing is dropped for being late and no state grows.
    """
    rows = snapshots.flatten_positions(landed, codes) if table == "positions" else snapshots.flatten_predictions(landed)
    return rows.unionByName(snapshots.unreadable_documents(landed), allowMissingColumns=True)


def progress_path(lake: Lake) -> str:
    """The audit of the streams: a row per table and micro-batch."""
    return lake.path("audit", "stream_progress")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What Spark calls the stream of this checkpoint, the same after every restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _last_taken(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last micro-batch that is whole in bronze; -1 for none."""
    folder = f"{checkpoint}/taken"
    recover(spark, folder)
    return spark.read.schema("batch bigint").parquet(folder).first()[0] if exists(spark, folder) else -1


def _prepare(
    spark: SparkSession, lake: Lake, table: str, rows: DataFrame, batch: int, run: str, aside: str
) -> None:
    """Write aside what the batch adds, and its counts last; rejects go to quarantine."""
    parsed = staged(rows, f"{aside}/parsed")
    documents = parsed.where("reason is not null").select("document", "reason")
    flat = parsed.where("reason is null").drop("document", "reason")
    done = store_batch(spark, lake, table, flat, run, documents, f"{aside}/rows")
    newest, broken = parsed.agg(F.max("collected_at"), F.count("reason")).first()
    counts = [done[c] for c in ("landed", "added", "duplicates", "outside_hours", "quarantined")]
    row = spark.createDataFrame([(batch, broken, *counts, newest)], PROGRESS)
    row.coalesce(1).write.parquet(f"{aside}/counts")


def _record(spark: SparkSession, lake: Lake, table: str, counts: DataFrame, run: str) -> None:
    """Put the batch's counts into the audit layer; repeating it replaces them."""
    day = counts.first()["newest"]
    folder = f"{progress_path(lake)}/table_name={table}/dt={day.date() if day else '1970-01-01'}/run={run}"
    counts.coalesce(1).write.mode("overwrite").parquet(folder)


def _mark(spark: SparkSession, checkpoint: str, batch: int) -> None:
    spark.createDataFrame([(batch,)], "batch bigint").coalesce(1).write.mode("overwrite").parquet(
        f"{checkpoint}/{STAGED}/taken"
    )
    swap_in(spark, f"{checkpoint}/{STAGED}/taken", f"{checkpoint}/taken")


def take_batch(
    spark: SparkSession, lake: Lake, checkpoint: str, table: str, rows: DataFrame, batch: int
) -> dict[str, int]:
    """Take one micro-batch into bronze, once however often it is called; returns its counts."""
    if batch <= _last_taken(spark, checkpoint):
        remove(spark, f"{checkpoint}/batch")
        return {}
    run, aside = f"stream-{_stream_id(spark, checkpoint)}-{batch}", f"{checkpoint}/batch/{batch}"
    if not exists(spark, f"{aside}/counts/_SUCCESS"):
        remove(spark, f"{checkpoint}/batch")
        _prepare(spark, lake, table, rows, batch, run, aside)
    publish(spark, f"{aside}/rows", lake.path("bronze", table), run)
    counts = spark.read.schema(PROGRESS).parquet(f"{aside}/counts")
    done = counts.drop("batch", "newest").first().asDict()
    _record(spark, lake, table, counts, run)
    _mark(spark, checkpoint, batch)
    remove(spark, f"{checkpoint}/batch")
    return done


def start_stream(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    table: str,
    codes: DataFrame | None = None,
    every: str | None = None,
    max_files: int = 1000,
    taken: Callable[[dict[str, int]], None] = lambda counts: None,
) -> StreamingQuery:
    """Start taking what lands into bronze; without ``every`` it stops once caught up.

    ``taken`` hears the counts of every micro-batch. One stream writes to a table, and no
    other job does while it runs.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}

    def each(rows: DataFrame, batch: int) -> None:
        taken(take_batch(spark, lake, checkpoint, table, rows, batch))

    return (
        flat_stream(snapshot_stream(spark, landing, table, max_files), table, codes)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    table: str,
    codes: DataFrame | None = None,
    max_files: int = 1000,
) -> dict[str, int]:
    """Bring everything that landed since the last call into bronze; returns what became of it.

    A micro-batch that broke off in an earlier call is finished first.
    """
    total: Counter[str] = Counter()
    start_stream(spark, landing, lake, checkpoint, table, codes, max_files=max_files, taken=total.update).awaitTermination()
    return dict(total)


def stream_progress(spark: SparkSession, lake: Lake, table: str | None = None) -> DataFrame:
    """The counts and the newest collection time of every micro-batch taken in."""
    schema = f"{PROGRESS}, table_name string, dt date, run string"
    if not exists(spark, progress_path(lake)):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(progress_path(lake))
    return rows if table is None else rows.where(F.col("table_name") == table)
