from __future__ import annotations

import json
from datetime import date

from fleetlake import schemas
from fleetlake.plans import daily, lineage
from fleetlake.plans.append import append
from fleetlake.sources import snapshots
from fleetlake.sources.layers import Lake, read_newest_day, read_table
from tests.conftest import at, rows_of


def landed(tmp_path):
    positions, predictions = tmp_path / "positions", tmp_path / "predictions"
    positions.mkdir()
    predictions.mkdir()
    vehicle = {"py": -23.5, "px": -46.6, "ta": "2025-08-14T13:00:00Z"}
    documents = [
        ("2025-08-14 10:00:00", [{"p": 1, **vehicle}, {"p": 2, **vehicle}, {"p": 1, **vehicle}]),
        ("2025-08-14 10:05:00", [{"p": 1, **vehicle}, {"p": 0, **vehicle}]),
        ("2025-08-14 23:30:00", [{"p": 1, **vehicle}]),  # outside the collection hours
    ]
    (positions / "a.json").write_text(
        "\n".join(
            json.dumps({"collected_at": t, "l": [{"c": "7281-21", "vs": vs}, {"c": "x-10", "vs": vs}]})
            for t, vs in documents
        )
    )
    arrivals = {"cp": 661, "vs": [{"p": 1, "t": "10:15"}]}
    (predictions / "a.json").write_text(
        json.dumps({"collected_at": "2025-08-14 10:00:00", "line_id": 905, "ps": [arrivals]})
    )
    return str(positions), str(predictions)


def test_daily_chain(spark, tmp_path, make_positions):
    lake = Lake(str(tmp_path / "lake"))
    positions, predictions = landed(tmp_path)
    catalog = spark.createDataFrame([(2160, "7281", 21, "a", "b")], schemas.LINE_CATALOG)
    expired = make_positions((1, "2025-08-01 10:00:00", 9, "7281-21", 0.0, 0.0))
    append(expired, lake.path("bronze", "positions"), "positions")
    append(expired, lake.path("silver", "positions"), "positions")

    arguments = (spark, lake, date(2025, 8, 14), at("2025-08-15 03:00:00"), positions, predictions, catalog, [2160])
    assert daily.run_daily(*arguments) == {
        "positions": {"collected": 3, "compacted": 3, "late": 0, "purged": 1},
        "predictions": {"collected": 1, "compacted": 1, "late": 0, "purged": 0},
    }
    silver = read_table(spark, lake.path("silver", "positions"), "positions")
    assert rows_of(silver.where("dt = date '2025-08-14'"), "vehicle_id") == [(1,), (1,), (2,)]
    assert silver.where("dt = date '2025-08-01'").count() == 1
    quarantine = spark.read.parquet(lake.path("quarantine", "positions"))
    assert rows_of(quarantine, "vehicle_id", "reasons") == [(0, "vehicle;")]
    audit = read_table(spark, daily.audit_path(lake), "lineage_audit")
    assert rows_of(audit, "asset_name", "row_count", "status") == [
        ("collect_positions", 3, "ok"),
        ("collect_predictions", 1, "ok"),
        ("compact_positions", 3, "ok"),
        ("compact_predictions", 1, "ok"),
        ("purge_positions", 1, "ok"),
        ("reconcile_positions", 0, "ok"),
        ("reconcile_predictions", 0, "ok"),
    ]

    # A second run on the same day changes no table.
    before = rows_of(silver)
    assert daily.run_daily(*arguments) == {
        "positions": {"collected": 0, "compacted": 3, "late": 0, "purged": 0},
        "predictions": {"collected": 0, "compacted": 1, "late": 0, "purged": 0},
    }
    assert rows_of(read_table(spark, lake.path("silver", "positions"), "positions")) == before
    assert spark.read.parquet(lake.path("quarantine", "positions")).count() == 1
    assert lineage.recent_runs(read_table(spark, daily.audit_path(lake), "lineage_audit")).count() == 10


def test_rows_that_come_late_are_archived_before_a_purge(spark, tmp_path, make_positions):
    lake, as_of = Lake(str(tmp_path)), at("2025-08-15 03:00:00")
    bronze, silver = (lake.path(layer, "positions") for layer in ("bronze", "silver"))
    rows = [(i, f"2025-08-0{1 + i % 8} 10:0{i % 6}:00", i, "A", 0.0, 0.0) for i in range(40)]
    append(make_positions(*rows[:10]), bronze, "positions")
    for day in range(1, 9):
        daily.compact_day(spark, lake, "positions", date(2025, 8, day), as_of)
    append(make_positions(*rows[10:]), bronze, "positions")
    assert daily.purge_table(spark, lake, "positions", as_of) == 35
    assert sorted(r[0] for r in rows_of(read_table(spark, silver, "positions"), "id")) == list(range(40))
    assert {r[0] for r in rows_of(read_table(spark, bronze, "positions"), "id")} == {i for i in range(40) if i % 8 == 7}
    # What is left of a purged day does not replace the archive.
    append(make_positions((99, "2025-08-01 10:00:00", 99, "A", 0.0, 0.0)), bronze, "positions")
    daily.compact_day(spark, lake, "positions", date(2025, 8, 1), as_of)
    daily.compact_changed(spark, lake, "positions", as_of)
    assert read_table(spark, silver, "positions").count() == 41


def test_every_landed_row_is_accounted_for(spark, tmp_path):
    lake, folder = Lake(str(tmp_path / "lake")), tmp_path / "landing"
    folder.mkdir()
    vehicle = {"py": -23.5, "px": -46.6, "ta": "2025-08-14T13:00:00Z"}
    good = [{"p": 1, **vehicle}, {"p": 1, **vehicle}, {"p": 2, **vehicle, "ta": "soon"}, {"p": None, **vehicle}]
    lines = [
        json.dumps({"collected_at": "2025-08-14 10:00:00", "l": [{"c": "a-1", "vs": good}]}),
        json.dumps({"collected_at": "2025-08-14 02:00:00", "l": [{"c": "a-1", "vs": good[:1]}]}),
        json.dumps({"collected_at": "not yet", "l": [{"c": "a-1", "vs": good[:1]}]}),
        json.dumps({"l": []}),
        '{"collected_at": "2025-08-14 10:05:00", "l": [{"c"',
    ]
    (folder / "a.json").write_text("\n".join(lines))
    (folder / "b.json").write_text(json.dumps({"collected_at": "2025-08-14 10:10:00", "l": []}, indent=2))
    read = snapshots.read_position_snapshots(spark, str(folder))
    rows = snapshots.flatten_positions(read)
    done = daily.store_batch(spark, lake, "positions", rows, "r", snapshots.unreadable_documents(read))
    assert done == {"landed": 6, "added": 1, "duplicates": 1, "outside_hours": 1, "quarantined": 3}
    refused = spark.read.parquet(daily.quarantine_path(lake, "positions", "r"))
    assert [r[0] for r in rows_of(refused, "reasons")] == ["time;", "unreadable;", "vehicle;"]
    documents = spark.read.parquet(f"{lake.path('quarantine', 'documents')}/positions/run=r")
    found = rows_of(documents.groupBy("reason").count())
    assert found[1] == ("no collection time", 1) and found[0][0] == "broken" and found[0][1] > 3
    assert rows_of(snapshots.delivered(read.where("l is not null"), "l"), "delivered") == [(0,), (1,), (1,), (4,)]


def test_lost_rows_raise_an_alert(spark, tmp_path, make_positions):
    lake = Lake(str(tmp_path))
    rows = [(i, "2025-08-14 10:00:00", i + 1, "A", 0.0, 0.0) for i in range(10)]
    append(make_positions(*rows), lake.path("bronze", "positions"), "positions")
    append(make_positions(*rows[:9]), lake.path("silver", "positions"), "positions")
    found = daily.check_layers(spark, lake, "positions", at("2025-08-15 03:00:00"))
    assert found.first()["passed"] is False
    audit = read_table(spark, daily.audit_path(lake), "lineage_audit")
    assert rows_of(audit, "asset_name", "status") == [("reconcile_positions", "alert")]


def test_health_reads_the_newest_day(spark, tmp_path, make_positions):
    lake = Lake(str(tmp_path))
    rows = [(i, f"2025-08-{10 + i} 10:00:00", 1, "A", 0.0, 0.0) for i in range(5)]
    rows.append((9, "2025-08-14 10:00:00", 2, "A", 0.0, 0.0))
    append(make_positions(*rows), lake.path("bronze", "positions"), "positions")
    found = daily.check_health(spark, lake, at("2025-08-14 10:30:00"))
    assert rows_of(found, "table_name", "is_empty", "is_stale", "batch_rows") == [
        ("positions", False, False, 2),
        ("predictions", True, None, 0),
    ]
    newest = read_newest_day(spark, lake.path("bronze", "positions"), "positions")
    assert "2025-08-14" in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1]
