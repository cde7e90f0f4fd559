from __future__ import annotations

import json

import pytest

from fleetlake.operators import quality
from fleetlake.plans import append, daily
from fleetlake.plans.append import idempotent_append
from fleetlake.sources import snapshots
from fleetlake.sources.layers import Lake, read_table
from fleetlake.streaming import ingest as ingest_module
from fleetlake.streaming.ingest import flat_stream, snapshot_stream, stream_ingest, stream_progress
from tests.conftest import at, rows_of


def land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents))


def positions(time, *vehicles, line="7281-21"):
    vs = [{"p": p, "py": lat, "px": -46.6, "ta": "2025-08-15T13:00:00Z"} for p, lat in vehicles]
    return {"collected_at": time, "l": [{"c": line, "vs": vs}]}


def ingest(spark, tmp_path, table, **options):
    lake = Lake(str(tmp_path / "lake"))
    stream_ingest(spark, str(tmp_path / "landing"), lake, str(tmp_path / "checkpoint"), table, **options)
    return read_table(spark, lake.path("bronze", table), table)


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", positions("2025-08-15 10:00:00", (1, -23.5), (2, -23.6), (1, -23.5)))
    land(landing, "b.json", positions("2025-08-15 10:05:00", (1, -23.5), (3, 100.0)))
    land(landing, "c.json", positions("2025-08-16 02:05:00", (1, -23.5), line="other"))
    (landing / "d.json").write_text('{"collected_at": "2025-08-15 10:00:00", "l"')
    stored = ingest(spark, tmp_path, "positions")
    batch = Lake(str(tmp_path / "batch"))
    landed = snapshots.read_position_snapshots(spark, str(landing))
    rows = snapshots.flatten_positions(landed)
    done = daily.store_batch(spark, batch, "positions", rows, "r", snapshots.unreadable_documents(landed))
    assert done == {"landed": 6, "added": 3, "duplicates": 1, "outside_hours": 1, "quarantined": 1}
    assert rows_of(stored) == rows_of(read_table(spark, batch.path("bronze", "positions"), "positions"))
    for folder in ("positions", "documents/positions"):
        both = [spark.read.parquet(f"{tmp_path}/{lake}/quarantine/{folder}").drop("run") for lake in ("lake", "batch")]
        assert rows_of(both[0]) == rows_of(both[1]) and both[0].count() == 1


def test_batch_jobs_work_after_a_stream(spark, tmp_path, make_positions):
    land(tmp_path / "landing", "a.json", positions("2025-08-15 10:00:00", (1, -23.5), (2, -23.6)))
    lake = Lake(str(tmp_path / "lake"))
    assert ingest(spark, tmp_path, "positions").count() == 2
    bronze = lake.path("bronze", "positions")
    again = make_positions((None, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0), (None, "2025-08-16 10:00:00", 1, "A", 0.0, 0.0))
    assert idempotent_append(again, bronze, "positions") == 1
    assert read_table(spark, bronze, "positions").count() == 3
    assert daily.purge_table(spark, lake, "positions", at("2025-08-22 12:00:00")) == 2
    assert read_table(spark, bronze, "positions").count() == 1


NULL_STOPS = {
    "collected_at": "2025-08-15 10:00:00",
    "line_id": 1,
    "ps": [{"cp": 5, "vs": [{"p": 7, "t": "10:15"}]}, {"cp": None, "vs": [{"p": 7, "t": "10:15"}, {"p": 7, "t": "10:15"}]}],
}


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", ["_prepare", "store_batch", "publish", "move", "_record", "_mark", "remove"])
def test_a_batch_broken_at_any_step_is_taken_once(spark, tmp_path, monkeypatch, step, when):
    """Rows with a NULL in the key tell: they equal nothing, so a second append would keep them again."""
    later = NULL_STOPS | {"collected_at": "2025-08-16 10:00:00"}
    land(tmp_path / "landing", "a.json", NULL_STOPS, later)
    (tmp_path / "landing/b.json").write_text('{"collected_at": ')
    module = append if step == "move" else ingest_module
    real, calls = getattr(module, step), []

    def broken(*arguments, **named):
        calls.append(1)
        first = len(calls) == (2 if step == "move" else 1)
        if first and when == "before":
            raise OSError("broken")
        result = real(*arguments, **named)
        if first:
            raise OSError("broken")
        return result

    monkeypatch.setattr(module, step, broken)
    with pytest.raises(Exception, match="broken"):
        ingest(spark, tmp_path, "predictions")
    monkeypatch.setattr(module, step, real)
    stored = ingest(spark, tmp_path, "predictions")
    assert rows_of(stored, "dt", "stop_id") == [(d, s) for d in (at("2025-08-15").date(), at("2025-08-16").date()) for s in (5, None, None)]
    lake = Lake(str(tmp_path / "lake"))
    assert rows_of(stream_progress(spark, lake, "predictions"), "batch", "documents", "landed", "added") == [(0, 1, 6, 6)]
    assert spark.read.parquet(str(tmp_path / "lake/quarantine/documents/predictions")).count() == 1
    assert not (tmp_path / "checkpoint/batch").exists()


def test_bookkeeping_stays_small(spark, tmp_path):
    """Whatever the number of batches: one number is kept, and no files of finished batches."""
    lake, landing = Lake(str(tmp_path / "lake")), tmp_path / "landing"
    for k in range(5):
        land(landing, f"{k}.json", positions(f"2025-08-15 10:0{k}:00", (1, -23.5), (2, 100.0)))
    counts = stream_ingest(spark, str(landing), lake, str(tmp_path / "checkpoint"), "positions", max_files=2)
    assert counts == {"documents": 0, "landed": 10, "added": 5, "duplicates": 0, "outside_hours": 0, "quarantined": 5}
    assert spark.read.parquet(str(tmp_path / "checkpoint/taken")).first()[0] == 2
    assert not (tmp_path / "checkpoint/batch").exists() and not (tmp_path / "lake/stream").exists()
    progress = stream_progress(spark, lake)
    assert rows_of(progress, "batch", "landed") == [(0, 4), (1, 4), (2, 2)]
    assert progress.agg({"newest": "max"}).first()[0] == at("2025-08-15 10:04:00")
    assert stream_progress(spark, Lake(str(tmp_path / "none"))).count() == 0


def test_a_new_checkpoint_starts_over_without_copies(spark, tmp_path):
    land(tmp_path / "landing", "a.json", positions("2025-08-15 10:00:00", (1, -23.5), (0, -23.5)))
    lake = Lake(str(tmp_path / "lake"))
    for checkpoint in ("one", "two"):
        stream_ingest(spark, str(tmp_path / "landing"), lake, str(tmp_path / checkpoint), "positions")
    assert read_table(spark, lake.path("bronze", "positions"), "positions").count() == 1
    assert rows_of(stream_progress(spark, lake), "added", "duplicates", "quarantined") == [(0, 1, 1), (1, 0, 1)]
    assert spark.read.parquet(str(tmp_path / "lake/quarantine/positions")).count() == 2


def test_restart_takes_new_files_only(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", positions("2025-08-15 10:00:00", (1, -23.5)))
    assert ingest(spark, tmp_path, "positions").count() == 1
    assert ingest(spark, tmp_path, "positions").count() == 1
    # The first snapshot lands again under another name, with a new one.
    land(landing, "b.json", positions("2025-08-15 10:00:00", (1, -23.5)), positions("2025-08-15 10:05:00", (1, -23.5)))
    stored = ingest(spark, tmp_path, "positions")
    assert [r[0] for r in rows_of(stored, "collected_at")] == [at("2025-08-15 10:00:00"), at("2025-08-15 10:05:00")]


def test_target_lines_in_the_stream(spark, tmp_path):
    land(
        tmp_path / "landing",
        "a.json",
        positions("2025-08-15 10:00:00", (1, -23.5)),
        positions("2025-08-15 10:00:00", (2, -23.5), line="6312-21"),
    )
    codes = spark.createDataFrame([("6312-21",)], "line_code string")
    assert rows_of(ingest(spark, tmp_path, "positions", codes=codes), "vehicle_id") == [(2,)]


def test_missing_stops_are_not_duplicates(spark, tmp_path):
    arrivals = [{"p": 7, "t": "10:15"}, {"p": 7, "t": "10:15"}]
    land(
        tmp_path / "landing",
        "a.json",
        {
            "collected_at": "2025-08-15 10:00:00",
            "line_id": 1,
            "ps": [{"cp": 5, "vs": arrivals}, {"cp": None, "vs": arrivals}],
        },
    )
    stored = ingest(spark, tmp_path, "predictions")
    assert rows_of(stored, "stop_id", "predicted_at") == [(5, "10:15"), (None, "10:15"), (None, "10:15")]


def test_empty_landing(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    assert ingest(spark, tmp_path, "positions").count() == 0


def test_freshness_of_the_sink(spark, tmp_path):
    land(tmp_path / "landing", "a.json", positions("2025-08-15 10:00:00", (1, -23.5)))
    stored = ingest(spark, tmp_path, "positions")
    assert rows_of(quality.freshness({"positions": stored}, at("2025-08-15 12:00:00"))) == [("positions", False, True)]


def test_stream_is_a_stream(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    rows = flat_stream(snapshot_stream(spark, str(tmp_path / "landing"), "positions"), "positions")
    assert rows.isStreaming
    assert {"collected_at", "vehicle_id", "unreadable", "document", "reason"} <= set(rows.columns)


def late_snapshots(spark, tmp_path, **options):
    landing = tmp_path / "landing"
    for name, time in (("a", "2025-08-15 10:00:00"), ("b", "2025-08-15 10:05:00"), ("c", "2025-08-01 10:00:00")):
        land(landing, f"{name}.json", positions(time, (1, -23.5)), positions(time, (1, -23.5)))
        stored = ingest(spark, tmp_path, "positions", **options)
    return [str(r[0]) for r in rows_of(stored, "collected_at")]


def test_no_row_is_late(spark, tmp_path):
    assert late_snapshots(spark, tmp_path) == [
        "2025-08-01 10:00:00",
        "2025-08-15 10:00:00",
        "2025-08-15 10:05:00",
    ]


def test_rejects_go_to_quarantine(spark, tmp_path):
    land(tmp_path / "landing", "a.json", positions("2025-08-15 10:00:00", (1, -23.5), (0, 100.0), (3, None)))
    assert rows_of(ingest(spark, tmp_path, "positions"), "vehicle_id") == [(1,)]
    refused = spark.read.parquet(str(tmp_path / "lake/quarantine/positions"))
    assert rows_of(refused, "vehicle_id", "reasons") == [(0, "vehicle;lat;"), (3, "lat;")]
