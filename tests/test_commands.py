from __future__ import annotations

import json

import pytest

from fleetlake.__main__ import run
from fleetlake.plans import dedup, status
from fleetlake.plans.append import append
from fleetlake.sources.layers import Lake, load_layer, read_table, stored_days
from tests.conftest import rows_of


@pytest.fixture
def lake(tmp_path, make_positions, make_predictions):
    lake = Lake(str(tmp_path / "lake"))
    append(
        make_positions(
            (1, "2025-08-01 10:00:00", 1, "A-10", 0.0, 0.0),
            (2, "2025-08-14 10:00:00", 1, "A-10", 0.0, 0.0),
            (3, "2025-08-14 10:00:00", 2, "A-10", 0.0, 0.0),
            (4, "2025-08-14 10:00:00", 1, "B-10", 1.0, 1.0),  # copy of 2
        ),
        lake.path("bronze", "positions"),
        "positions",
    )
    append(
        make_predictions(
            (1, "2025-08-14 10:00:00", 5, 1, None, "10:15"),
            (2, "2025-08-14 10:00:00", 5, 1, None, "10:15"),  # NULLs are equal here
        ),
        lake.path("bronze", "predictions"),
        "predictions",
    )
    return lake


def stored(spark, lake, table, layer="bronze"):
    return read_table(spark, lake.path(layer, table), table)


def test_remove_duplicates(spark, lake):
    for table, removed, left in (("positions", 1, [1, 2, 3]), ("predictions", 1, [1])):
        path = lake.path("bronze", table)
        assert dedup.remove_duplicates(spark, path, table) == removed
        assert [r[0] for r in rows_of(stored(spark, lake, table), "id")] == left
        assert dedup.remove_duplicates(spark, path, table) == 0
    assert stored_days(spark, lake.path("bronze", "positions")) == {"2025-08-01", "2025-08-14"}
    assert rows_of(stored(spark, lake, "positions").where("id = 2"), "line_code") == [("A-10",)]


def test_status_refresh(spark, lake, make_positions):
    assert status.refresh_fleet_status(spark, lake, "bronze") == 4
    assert status.refresh_fleet_status(spark, lake, "bronze") == 4
    found = load_layer(spark, lake, "fleet_status", fall_back_if_empty=True)
    assert rows_of(found, "id", "predicted_arrival") == [(1, "10:15"), (2, "10:15"), (3, None), (4, "10:15")]
    append(make_positions((9, "2025-08-15 10:00:00", 7, "A-10", 0.0, 0.0)), lake.path("silver", "positions"), "positions")
    assert status.refresh_fleet_status(spark, lake) == 1
    assert status.refresh_fleet_status(spark, Lake(lake.root + "/none")) == 0


def test_commands(spark, lake, tmp_path):
    def command(*arguments):
        return run(spark, ["--root", lake.root, "--as-of", "2025-08-15T03:00:00", *arguments])

    assert command("dedup") == ["positions: 1 rows removed", "predictions: 1 rows removed"]
    assert command("compact", "--date", "2025-08-14") == ["positions: 2 rows written", "predictions: 1 rows written"]
    assert command("purge", "--dry-run") == ["positions: 1 rows would be removed", "predictions: 0 rows would be removed"]
    # The old day is archived first.
    assert command("purge") == ["positions: 1 rows removed", "predictions: 0 rows removed"]
    assert command("compact") == ["positions: 2 rows written", "predictions: 1 rows written"]
    assert command("reconcile") == []
    assert command("purge") == ["positions: 0 rows removed", "predictions: 0 rows removed"]
    assert command("status", "--source", "silver") == ["fleet_status: 3 rows"]
    assert len(command("health")) == 2

    landing, catalog = tmp_path / "landing", tmp_path / "lines.csv"
    landing.mkdir()
    vehicle = {"p": 77, "py": 0.0, "px": 0.0, "ta": None}
    (landing / "a.json").write_text(
        json.dumps({"collected_at": "2025-08-15 06:00:00", "l": [{"c": "A-10", "vs": [vehicle]}]})
    )
    catalog.write_text("line_id,line_number,line_suffix,outbound_name,return_name\n7,A,10,x,y\n")
    arguments = ("collect", "--positions", str(landing), "--catalog", str(catalog), "--targets")
    assert command(*arguments, "8") == ["positions: 0 rows added"]
    assert command(*arguments, "7, 8") == ["positions: 1 rows added"]
    assert command(*arguments, "7, 8") == ["positions: 0 rows added"]
