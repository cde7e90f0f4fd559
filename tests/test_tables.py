from __future__ import annotations

import threading

import pytest

from fleetlake.plans import tables
from fleetlake.plans.append import append
from fleetlake.sources.layers import read_table
from fleetlake.sources.paths import exists
from tests.conftest import rows_of

A, B, C = "2025-08-14", "2025-08-15", "2025-08-16"


@pytest.fixture
def named(spark, tmp_path, make_positions):
    """A table of two days, two rows in the first."""
    path = str(tmp_path / "bronze" / "positions")
    spark.sql("CREATE DATABASE IF NOT EXISTS named_test")
    name = f"named_test.{tmp_path.name.replace('-', '_')}"
    rows = make_positions(
        (1, f"{A} 10:00:00", 1, "x-10", 0.0, 0.0),
        (2, f"{A} 11:00:00", 2, "x-10", 0.0, 0.0),
        (3, f"{B} 10:00:00", 1, "x-10", 0.0, 0.0),
    )
    append(rows, path, "positions")
    tables.register(spark, name, "positions", path)
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_days_are_known_by_name_and_registering_again_changes_nothing(spark, named):
    name, path = named
    assert rows_of(spark.table(name), "id") == [(1,), (2,), (3,)]
    tables.register(spark, name, "positions", path)
    assert tables.known_days(spark, name) == {A, B}


def test_an_empty_place_is_a_table_without_rows(spark, tmp_path, make_positions):
    spark.sql("CREATE DATABASE IF NOT EXISTS named_test")
    tables.register(spark, "named_test.nothing", "positions", str(tmp_path / "none"))
    assert spark.table("named_test.nothing").count() == 0
    row = make_positions((1, f"{A} 10:00:00", 1, "x-10", 0.0, 0.0))
    assert tables.compact_into(row.where("id < 0"), "named_test.nothing", "positions") == 0
    assert tables.append_rows(row, "named_test.nothing", "positions") == 1
    assert rows_of(spark.table("named_test.nothing"), "id") == [(1,)]
    spark.sql("DROP TABLE named_test.nothing")


def test_a_replaced_day_holds_the_new_rows_and_other_days_theirs(spark, named, make_positions):
    name, _ = named
    row = make_positions((9, f"{A} 12:00:00", 9, "x-10", 0.0, 0.0))
    assert tables.replace_days(row, name, "positions") == 1
    assert rows_of(spark.table(name), "id") == [(3,), (9,)]
    assert rows_of(spark.table(name).where(f"dt = date '{A}'"), "id") == [(9,)]


def test_replacing_all_drops_days_without_rows_and_adds_new_ones(spark, named, make_positions):
    name, _ = named
    rows = make_positions((7, f"{B} 12:00:00", 9, "x-10", 0.0, 0.0), (8, f"{C} 12:00:00", 9, "x-10", 0.0, 0.0))
    assert tables.replace_all(rows, name, "positions") == 2
    assert rows_of(spark.table(name), "id") == [(7,), (8,)]
    assert tables.known_days(spark, name) == {B, C}


def test_merging_keeps_stored_rows_and_changes_nothing_the_second_time(spark, named, make_positions):
    name, _ = named
    rows = make_positions(
        (2, f"{A} 11:00:00", 2, "x-10", 0.0, 0.0), (4, f"{A} 12:00:00", 4, None, 0.0, 0.0)
    )
    for _ in range(2):
        assert tables.compact_into(rows, name, "positions") == 3
        assert rows_of(spark.table(name), "id") == [(1,), (2,), (3,), (4,)]


def test_rows_are_appended_where_a_moved_day_lies(spark, named, make_positions):
    name, _ = named
    tables.replace_days(make_positions((9, f"{A} 12:00:00", 9, "x-10", 0.0, 0.0)), name, "positions")
    more = make_positions(
        (10, f"{A} 13:00:00", 9, "x-10", 0.0, 0.0),
        (11, f"{B} 13:00:00", 9, "x-10", 0.0, 0.0),
        (12, f"{C} 13:00:00", 9, "x-10", 0.0, 0.0),
    )
    assert tables.append_rows(more, name, "positions") == 3
    assert rows_of(spark.table(name), "id") == [(10,), (11,), (12,), (3,), (9,)]


def test_a_reader_from_before_the_change_goes_on_and_unused_folders_go_later(spark, named, make_positions):
    name, path = named
    before = spark.table(name)
    before.count()  # the files are listed now
    tables.replace_days(make_positions((9, f"{A} 12:00:00", 9, "x-10", 0.0, 0.0)), name, "positions")
    assert tables.remove_unused(spark, name) == 0
    assert rows_of(read_table(spark, path, "positions"), "id") == [(1,), (2,), (3,)]
    assert tables.remove_unused(spark, name, keep_hours=0) == 1
    assert not exists(spark, f"{path}/dt={A}")
    assert rows_of(spark.table(name), "id") == [(3,), (9,)]
    tables.replace_days(make_positions((5, f"{A} 12:00:00", 9, "x-10", 0.0, 0.0)), name, "positions")
    assert tables.remove_unused(spark, name, keep_hours=0) == 1
    assert rows_of(spark.table(name), "id") == [(3,), (5,)]


def test_no_reader_sees_a_day_missing(spark, named, make_positions):
    name, _ = named
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append({str(r.dt) for r in spark.table(name).select("dt").distinct().collect()})

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(6):
            tables.replace_days(make_positions((100 + i, f"{A} 12:00:00", 9, "x-10", 0.0, 0.0)), name, "positions")
    finally:
        done.set()
        reader.join()
    assert len(seen) > 1
    assert all(days == {A, B} for days in seen)
