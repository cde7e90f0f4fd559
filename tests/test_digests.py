from __future__ import annotations

from datetime import date

import pytest

from fleetlake.plans import daily
from fleetlake.plans.append import append
from fleetlake.plans.dedup import remove_duplicates
from fleetlake.plans.digests import Archive, file_fingerprints, row_digest
from fleetlake.sources.layers import Lake, read_table
from fleetlake.sources.paths import remove
from tests.conftest import at

AS_OF = at("2025-08-15 03:00:00")


def day_rows(make_positions, ids, vehicle=1):
    return make_positions(*[(i, f"2025-08-{10 + i % 4} 10:00:00", vehicle, "A", 0.0, 0.0) for i in ids])


@pytest.fixture
def lake(spark, tmp_path, make_positions):
    """Four days in bronze, all of them in silver."""
    lake = Lake(str(tmp_path))
    append(day_rows(make_positions, range(12)), lake.path("bronze", "positions"), "positions")
    assert daily.compact_changed(spark, lake, "positions", AS_OF) == 12
    return lake


def test_unchanged_days_are_not_read(spark, lake, make_positions):
    archive = Archive(spark, lake, "positions")
    assert archive.lacking() == {} and archive.scanned == {"bronze": [], "silver": []}
    append(day_rows(make_positions, [101, 102]), lake.path("bronze", "positions"), "positions")
    archive = Archive(spark, lake, "positions")
    assert archive.lacking() == {"2025-08-11": 1, "2025-08-12": 1}
    assert archive.scanned == {"bronze": [], "silver": []}  # the counts tell
    assert daily.compact_changed(spark, lake, "positions", AS_OF) == 2
    assert Archive(spark, lake, "positions").lacking() == {}
    assert read_table(spark, lake.path("silver", "positions"), "positions").count() == 14


def test_a_day_that_lost_copies_is_compared_once(spark, lake, make_positions):
    bronze = lake.path("bronze", "positions")
    append(day_rows(make_positions, range(12), vehicle=2), bronze, "positions")
    assert daily.compact_changed(spark, lake, "positions", AS_OF) == 12
    removed = remove_duplicates(spark, bronze, "positions")
    assert removed == 16
    # Silver holds more than bronze now, so the rows are compared; after that they are known.
    first, second = Archive(spark, lake, "positions"), None
    assert first.lacking() == {} and len(first.scanned["bronze"]) == 4
    first.save()
    second = Archive(spark, lake, "positions")
    assert second.lacking() == {} and second.scanned == {"bronze": [], "silver": []}


def test_same_counts_with_other_rows_are_lacking(spark, lake, make_positions):
    silver, bronze = (lake.path(layer, "positions") for layer in ("silver", "bronze"))
    remove(spark, f"{silver}/dt=2025-08-10")
    append(make_positions(*[(90 + i, "2025-08-10 10:00:00", 1, "A", 0.0, 0.0) for i in range(3)]), silver, "positions")
    archive = Archive(spark, lake, "positions")
    assert archive.lacking() == {"2025-08-10": 3}
    assert archive.scanned["silver"] == ["2025-08-10"]
    assert daily.purge_table(spark, lake, "positions", at("2025-08-18 03:00:00")) == 3
    assert read_table(spark, silver, "positions").where("dt = date '2025-08-10'").count() == 6
    assert "2025-08-10" not in Archive(spark, lake, "positions").days
    assert read_table(spark, bronze, "positions").count() == 9


def test_the_state_may_be_lost(spark, lake):
    remove(spark, lake.path("state", "positions"))
    archive = Archive(spark, lake, "positions")
    assert archive.lacking() == {} and len(archive.scanned["bronze"]) == len(archive.scanned["silver"]) == 4


def test_what_a_partial_purge_leaves_stays_proven(spark, tmp_path, make_positions):
    lake = Lake(str(tmp_path))
    rows = [(i, f"2025-08-10 {8 + i}:00:00" if i > 1 else f"2025-08-10 0{8 + i}:00:00", 1, "A", 0.0, 0.0) for i in range(8)]
    append(make_positions(*rows), lake.path("bronze", "positions"), "positions")
    assert daily.purge_table(spark, lake, "positions", at("2025-08-17 12:00:00")) == 4
    archive = Archive(spark, lake, "positions")
    assert archive.lacking() == {} and archive.scanned == {"bronze": [], "silver": []}
    assert daily.compact_day(spark, lake, "positions", date(2025, 8, 10), AS_OF) == 8
    assert daily.compact_day(spark, lake, "positions", date(2025, 8, 11), AS_OF) == 0


def test_digest_tells_rows_apart(spark, make_positions):
    digest = lambda df: df.agg(row_digest(df)).first()[0]
    a, b = (1, "2025-08-10 10:00:00", 1, "A", 0.0, 0.0), (2, "2025-08-10 10:00:00", 1, None, 0.0, 0.0)
    assert digest(make_positions(a, b)) == digest(make_positions(b, a).repartition(3))
    assert digest(make_positions(a, a)) != digest(make_positions(a))
    assert digest(make_positions(a, a)) != digest(make_positions(a, b))
    shifted = spark.createDataFrame([(None, 5, 7), (5, None, 7)], "x long, y long, z long")
    assert digest(shifted.limit(1)) != digest(shifted.offset(1))
    assert digest(make_positions(a).limit(0)) == ""


def test_fingerprints_follow_the_files(spark, lake, make_positions):
    folders = [f"{lake.path(layer, 'positions')}/dt=2025-08-{day}" for layer in ("bronze", "silver") for day in (10, 11)]
    files = file_fingerprints(spark, folders)
    assert sorted(files) == folders and files == file_fingerprints(spark, folders[::-1])
    append(make_positions((50, "2025-08-11 10:00:00", 1, "A", 0.0, 0.0)), lake.path("bronze", "positions"), "positions")
    assert [f for f in folders if file_fingerprints(spark, folders)[f] != files[f]] == folders[1:2]
