from __future__ import annotations

import json

import pytest

from fleetlake import schemas
from fleetlake.plans.append import append
from fleetlake.sources import files, snapshots
from fleetlake.sources.layers import Lake, load_layer, read_silver, stored_days
from tests.conftest import at, rows_of


def land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents))
    return str(folder)


def vehicle(p, py=-23.5, px=-46.6, ta="2025-08-15T13:00:00Z"):
    return {"p": p, "a": True, "ta": ta, "py": py, "px": px}


def test_flatten_positions(spark, tmp_path):
    path = land(
        tmp_path / "landing",
        "a.json",
        {
            "collected_at": "2025-08-15 10:00:00.123456",
            "hr": "10:00",
            "l": [
                {"c": "7281-21", "cl": 1, "vs": [vehicle(40217), vehicle("40533")]},
                {"c": "6312-21", "vs": [vehicle(7, ta=None)]},
                {"c": "no-vehicles", "vs": []},
                {"c": "absent"},
            ],
        },
        {"collected_at": "2025-08-15 10:05:00", "l": []},
        {"collected_at": "2025-08-15 10:10:00"},
    )
    flat = snapshots.flatten_positions(snapshots.read_position_snapshots(spark, path))
    time = at("2025-08-15 10:00:00.123456")
    assert rows_of(flat, "collected_at", "vehicle_id", "line_code", "lat", "lon", "position_at") == [
        (time, 40217, "7281-21", -23.5, -46.6, at("2025-08-15 13:00:00")),
        (time, 40533, "7281-21", -23.5, -46.6, at("2025-08-15 13:00:00")),
        (time, 7, "6312-21", -23.5, -46.6, None),
    ]
    assert flat.select("ordinal").distinct().count() == 3
    local = snapshots.flatten_positions(
        snapshots.read_position_snapshots(spark, path), gps_zone="America/Sao_Paulo"
    )
    assert local.where("vehicle_id = 40217").first()["position_at"] == at("2025-08-15 10:00:00")


def test_only_target_lines(spark, tmp_path):
    path = land(
        tmp_path / "landing",
        "a.json",
        {
            "collected_at": "2025-08-15 10:00:00",
            "l": [
                {"c": "7281-21", "vs": [vehicle(1), vehicle(2)]},
                {"c": "6312-21", "vs": [vehicle(3)]},
                {"c": None, "vs": [vehicle(4)]},
            ],
        },
    )
    catalog = spark.createDataFrame(
        [(2160, "7281", 21, "a", "b"), (2161, "6312", 21, "a", "b"), (2162, None, 21, "a", "b")],
        schemas.LINE_CATALOG,
    )
    landed = snapshots.read_position_snapshots(spark, path)
    for ids, vehicles in (([2160], [1, 2]), ([2160, 2161, 2162, 5], [1, 2, 3]), ([], [])):
        codes = snapshots.target_codes(catalog, ids)
        flat = snapshots.flatten_positions(landed, codes)
        assert [r[0] for r in rows_of(flat, "vehicle_id")] == vehicles


def test_flatten_predictions(spark, tmp_path):
    path = land(
        tmp_path / "landing",
        "a.json",
        {
            "collected_at": "2025-08-15 10:00:00",
            "line_id": 905,
            "ps": [{"cp": 661, "vs": [{"p": 311, "t": "10:15"}, {"p": "312", "t": "10:20"}]}, {"cp": 662}],
        },
        {"collected_at": "2025-08-15 10:00:00", "line_id": 2412, "ps": None},
    )
    flat = snapshots.flatten_predictions(snapshots.read_prediction_snapshots(spark, path))
    assert rows_of(flat, "line_id", "vehicle_id", "stop_id", "predicted_at") == [
        (905, 311, 661, "10:15"),
        (905, 312, 661, "10:20"),
    ]


def test_empty_landing_file(spark, tmp_path):
    path = land(tmp_path / "landing", "a.json")
    assert snapshots.flatten_positions(snapshots.read_position_snapshots(spark, path)).count() == 0


def test_operating_hours(make_positions):
    times = ["04:59:59", "05:00:00", "23:00:00", "23:00:00.5", "12:00:00", None]
    rows = make_positions(
        *[
            (i, "2025-08-15 10:00:00", i, "A", 0.0, 0.0, f"2025-08-15 {t}" if t else None)
            for i, t in enumerate(times)
        ]
    )
    assert [r[0] for r in rows_of(snapshots.operating_hours(rows), "id")] == [1, 2, 4]


def test_catalog(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("line_id,line_number,line_suffix,outbound_name,return_name\n1,8000,10,Lapa,Centro\n2,917H,21,Sul,\n")
    assert rows_of(files.read_catalog(spark, str(path))) == [
        (1, "8000", 10, "Lapa", "Centro"),
        (2, "917H", 21, "Sul", None),
    ]
    missing = str(tmp_path / "absent.csv")
    with pytest.raises(FileNotFoundError):
        files.read_catalog(spark, missing)
    assert files.read_catalog(spark, missing, required=False) is None


def test_reports(spark, tmp_path):
    (tmp_path / "completeness.txt").write_text("7281-21|64|0.75\n6312-21|20|0.25\n")
    (tmp_path / "centroids.txt").write_text("7281-21|-23.41|-46.72|58\n")
    (tmp_path / "metrics.csv").write_text("line,lat,lon,n\n7281-21,-23.41,-46.72,58\n")
    (tmp_path / "gps.csv").write_text("1|2025-03-02 09:21:40|40217|7281-21|-23.5|-46.6|2025-03-02T12:20:05Z\n")
    path = str(tmp_path)
    assert rows_of(files.read_completeness_report(spark, f"{path}/completeness.txt")) == [
        ("6312-21", 20, 25.0),
        ("7281-21", 64, 75.0),
    ]
    line = [("7281-21", -23.41, -46.72, 58)]
    assert rows_of(files.read_centroid_report(spark, f"{path}/centroids.txt")) == line
    assert rows_of(files.read_line_metrics(spark, f"{path}/metrics.csv")) == line
    assert rows_of(files.read_gps_sample(spark, f"{path}/gps.csv")) == [
        (1, at("2025-03-02 09:21:40"), 40217, "7281-21", -23.5, -46.6, at("2025-03-02 12:20:05"))
    ]
    for read in (files.read_completeness_report, files.read_centroid_report, files.read_line_metrics):
        assert read(spark, f"{path}/absent").count() == 0


def test_load_layer(spark, tmp_path, make_positions):
    lake = Lake(str(tmp_path))
    assert load_layer(spark, lake, "positions").count() == 0
    append(make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0)), lake.path("bronze", "positions"), "positions")
    assert rows_of(load_layer(spark, lake, "positions"), "id") == [(1,)]
    silver = lake.path("silver", "positions")
    append(make_positions(), silver, "positions")
    assert load_layer(spark, lake, "positions").count() == 0
    assert rows_of(load_layer(spark, lake, "positions", fall_back_if_empty=True), "id") == [(1,)]
    append(make_positions((2, "2025-08-16 10:00:00", 1, "A", 0.0, 0.0)), silver, "positions")
    assert rows_of(load_layer(spark, lake, "positions"), "id") == [(2,)]
    assert read_silver(spark, silver, "positions").columns == schemas.POSITIONS.names
    assert stored_days(spark, silver) == {"2025-08-16"}
    assert load_layer(spark, lake, "predictions").columns == schemas.PREDICTIONS.names


def test_documents_over_several_lines(spark, tmp_path):
    document = {"collected_at": "2025-08-14 10:00:00", "l": [{"c": "a-1", "vs": [{"p": "1", "py": -23.5, "px": -46.6, "ta": None}]}]}
    other = document | {"collected_at": "2025-08-14 10:05:00"}
    (tmp_path / "a b+c.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([document, other], indent=1))
    (tmp_path / "c.json").write_text(json.dumps(document) + '\n{"collected_at": \n' + json.dumps(other))
    (tmp_path / "d.json").write_text(json.dumps(document, indent=2)[:-3])
    (tmp_path / "e.json").write_text(json.dumps(document, indent=2) + json.dumps(other, indent=2))
    (tmp_path / "f.json").write_text(json.dumps(document))
    read = snapshots.read_position_snapshots(spark, str(tmp_path), whole_files=True)
    rows = snapshots.flatten_positions(read)
    found = rows_of(rows.groupBy("collected_at").count())
    # One of a, two of b, two of c, one of f; the texts of d and e are no document.
    assert found == [(at("2025-08-14 10:00:00"), 4), (at("2025-08-14 10:05:00"), 2)]
    refused = snapshots.unreadable_documents(read)
    assert refused.where("reason = 'broken'").count() > 10
    assert snapshots.unreadable_documents(snapshots.read_position_snapshots(spark, str(tmp_path))).count() > refused.count()
    assert snapshots.read_position_snapshots(spark, str(tmp_path / "f.json"), whole_files=True).columns == read.columns
