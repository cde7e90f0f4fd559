from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators import fleet
from tests.conftest import rows_of

SNAPSHOT = "2025-08-15 10:00:00"


@pytest.fixture
def positions(make_positions):
    return make_positions(
        (1, SNAPSHOT, 311, "7281-21", -23.6041, -46.7012, "2025-08-15 09:59:00"),
        (2, SNAPSHOT, 312, "7281-21", -23.6052, -46.7003, "2025-08-15 09:58:00"),
    )


def test_status_takes_the_vehicles_prediction(positions, make_predictions):
    predictions = make_predictions(
        (1, SNAPSHOT, 905, 311, 661, "10:15"), (2, SNAPSHOT, 905, 312, 662, "10:12")
    )
    status = fleet.fleet_status(positions, predictions)
    assert status.columns == schemas.FLEET_STATUS.names
    assert rows_of(status, "vehicle_id", "next_stop_id", "predicted_arrival") == [
        (311, 661, "10:15"),
        (312, 662, "10:12"),
    ]


def test_status_keeps_vehicles_without_prediction(positions, make_predictions):
    status = fleet.fleet_status(positions, make_predictions((1, SNAPSHOT, 905, 311, 661, "10:15")))
    assert rows_of(status, "vehicle_id", "next_stop_id") == [(311, 661), (312, None)]


def test_status_without_predictions(positions, make_predictions):
    for none in (None, make_predictions()):
        status = fleet.fleet_status(positions, none)
        assert status.columns == schemas.FLEET_STATUS.names
        assert rows_of(status, "vehicle_id", "next_stop_id", "predicted_arrival") == [
            (311, None, None),
            (312, None, None),
        ]


def test_first_prediction_order(make_predictions):
    predictions = make_predictions(
        (5, SNAPSHOT, 1, 7, 50, "10:15"),
        (6, SNAPSHOT, 1, 7, 60, "09:59"),
        (4, "2025-08-15 09:00:00", 1, 7, 40, "09:59"),  # same text, earlier snapshot
        (1, SNAPSHOT, 1, 7, 10, None),  # missing time sorts last
        (2, SNAPSHOT, 1, 8, 20, None),  # all there is
        (9, SNAPSHOT, 1, 9, 91, "08:00"),
        (8, SNAPSHOT, 1, 9, 81, "08:00"),  # same text and snapshot, smaller id
    )
    assert rows_of(fleet.first_prediction(predictions)) == [
        (7, 40, "09:59"),
        (8, 20, None),
        (9, 81, "08:00"),
    ]
    newest = fleet.first_prediction(predictions, last_snapshot_only=True)
    assert (7, 60, "09:59") in rows_of(newest)


def test_latest_position(make_status):
    status = make_status(
        (1, "2025-08-15 10:00:00", 1, "A-10", -23.1, -46.1),
        (2, "2025-08-15 10:05:00", 1, "A-10", -23.2, -46.2),
        (3, "2025-08-15 10:05:00", 1, "B-10", -23.3, -46.3),  # same time, larger id
        (4, "2025-08-15 10:00:00", 2, "A-10", -23.4, -46.4),
        (5, "2025-08-15 10:05:00", 2, "A-10", None, None),  # last row has no place
    )
    assert rows_of(fleet.latest_position(status)) == [(1, -23.3, -46.3)]
    assert rows_of(fleet.latest_position(status, "A-10")) == [(1, -23.2, -46.2)]
    assert rows_of(fleet.latest_position(status, "none")) == []


def test_five_minutes_is_not_stuck(make_status):
    status = make_status(
        (1, "2025-08-15 10:00:00", 311, "7281-21", -23.55, -46.63),
        (2, "2025-08-15 10:05:00", 311, "7281-21", -23.55, -46.63),
        (3, "2025-08-15 10:00:00", 312, "7281-21", -23.56, -46.64),
    )
    assert fleet.stuck_vehicles(status).count() == 0


def test_moving_vehicle_is_not_stuck(make_status):
    status = make_status(
        (1, "2025-08-15 10:00:00", 311, "7281-21", -23.55, -46.63),
        (2, "2025-08-15 10:30:00", 311, "7281-21", -23.56, -46.63),
    )
    assert fleet.stuck_vehicles(status).count() == 0


def test_stuck_vehicle(make_status):
    status = make_status(
        (1, "2025-08-15 10:00:00", 311, None, -23.5500, -46.6300),
        (2, "2025-08-15 10:15:00", 311, "7281-21", -23.6000, -46.7000),  # away and back
        (3, "2025-08-15 10:30:00", 311, "6312-21", -23.5501, -46.6300),
        (4, "2025-08-15 10:00:00", 312, "7281-21", -23.5500, -46.6300),
        (5, "2025-08-15 10:10:00", 312, "7281-21", -23.5500, -46.6300),  # exactly ten
        (6, "2025-08-15 10:00:00", 1003, None, -23.5500, -46.6300),
        (7, "2025-08-15 10:11:00", 1003, None, -23.5500, -46.6300),
    )
    found = {r["vehicle_id"]: r for r in fleet.stuck_vehicles(status).collect()}
    assert set(found) == {311, 1003}
    assert found[311]["line_code"] == "7281-21"
    assert found[311]["elapsed_min"] == 30
    assert found[311]["distance_km"] == pytest.approx(6371.009 * math.radians(0.0001), rel=1e-6)
    assert found[1003]["line_code"] is None
    assert rows_of(fleet.count_by_line(fleet.stuck_vehicles(status))) == [("7281-21", 1)]


def test_bunching_compares_neighbours_only(make_status):
    status = make_status(
        (1, SNAPSHOT, 1, "A-10", -23.5500, -46.63),
        (2, SNAPSHOT, 2, "A-10", -23.5510, -46.63),  # 111 m from 1
        (3, SNAPSHOT, 3, "A-10", -23.5520, -46.63),  # 111 m from 2, 222 m from 1
        (4, SNAPSHOT, 4, "A-10", -23.5600, -46.63),  # alone
        (5, SNAPSHOT, 5, "B-10", -23.5500, -46.63),  # other line
        (6, "2025-08-15 10:05:00", 6, "A-10", -23.5500, -46.63),  # other snapshot
        (7, SNAPSHOT, 7, None, -23.5500, -46.63),
        (8, SNAPSHOT, 8, None, -23.5500, -46.63),  # no line is no group
    )
    events = fleet.bunched_events(status)
    assert rows_of(events, "vehicle_id", "next_vehicle_id") == [(2, 1), (3, 2)]
    assert rows_of(fleet.count_by_line(events)) == [("A-10", 2)]
    assert fleet.bunched_events(status, max_metres=100).count() == 0
    distance = events.first()["distance_m"]
    assert distance == pytest.approx(6371009 * math.radians(0.001), rel=1e-9)


def test_kpis(make_status):
    status = make_status(
        (1, SNAPSHOT, 1, "A-10", -23.5500, -46.63),
        (2, SNAPSHOT, 2, "A-10", -23.5501, -46.63),
        (3, SNAPSHOT, 3, None, -23.5502, -46.63),
        (4, SNAPSHOT, 4, "B-10", -23.5502, -46.63),
    )
    assert rows_of(fleet.fleet_kpis(status)) == [(4, 2, 1)]
    assert rows_of(fleet.fleet_kpis(status.where("false"))) == [(0, 0, 0)]
    assert [r[0] for r in fleet.line_list(status).collect()] == ["A-10", "B-10"]


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [
            (1, "7281", 21, "Hill", "Harbour"),
            (2, "917H", 21, "Metro", None),
            (3, "N1", 10, "North", "South"),
        ],
        schemas.LINE_CATALOG,
    )


def test_line_names(spark, catalog):
    lines = spark.createDataFrame(
        [("7281-21", 3), ("917H-21", 2), ("N1", 1), ("8000-x", 1), ("9-10", 1)], "line_code string, n int"
    )
    assert dict(fleet.enrich_line_names(lines, catalog).select("line_code", "line_name").collect()) == {
        "7281-21": "Hill / Harbour",
        "917H-21": "917H-21",  # one terminal is missing
        "N1": "North / South",  # no dash means suffix 10
        "8000-x": "8000-x",  # not a number
        "9-10": "9-10",  # not in the catalogue
    }


def test_line_names_without_catalog(spark):
    lines = spark.createDataFrame([("7281-21", 3)], "line_code string, n int")
    assert rows_of(fleet.enrich_line_names(lines, None)) == [("7281-21", 3, "7281-21")]


def test_missing_coordinate_has_no_distance(make_status):
    status = make_status(
        (1, "2025-08-15 10:00:00", 1, "A-10", -23.55, -46.63),
        (2, "2025-08-15 11:00:00", 1, "A-10", None, None),
    )
    assert fleet.stuck_vehicles(status).count() == 0
    assert status.where(F.col("lat").isNull()).count() == 1


def test_unique_times_change_nothing(spark):
    # One row per vehicle and time; every fifth vehicle rests, some rows name no line.
    i = F.col("id")
    status = spark.range(3000).select(
        "id",
        F.timestamp_add("MINUTE", (i * 7 % 3000).cast("int"), F.lit("2025-08-15 00:00:00").cast("timestamp_ntz"))
        .cast("timestamp_ntz")
        .alias("analyzed_at"),
        (i % 60).alias("vehicle_id"),
        F.when(i % 4 != 0, F.concat(F.lit("L"), (i % 3).cast("string"))).alias("line_code"),
        F.when(i % 5 == 0, F.lit(-23.5)).otherwise(-23.5 - (i * 13 % 400) / 1e4).alias("lat"),
        F.lit(-46.6).alias("lon"),
    )
    assert status.select("vehicle_id", "analyzed_at").distinct().count() == 3000
    general, fast = (fleet.stuck_vehicles(status, unique_times=u) for u in (False, True))
    assert general.count() >= 12
    assert rows_of(general) == rows_of(fast)
    assert rows_of(fleet.latest_position(status)) == rows_of(fleet.latest_position(status, unique_times=True))
    assert rows_of(fleet.latest_position(status, "L1")) == rows_of(
        fleet.latest_position(status, "L1", unique_times=True)
    )
