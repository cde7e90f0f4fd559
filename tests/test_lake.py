from __future__ import annotations

import glob
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.plans import append as appending
from fleetlake.plans import backfill, compaction, dedup, lineage, retention
from fleetlake.sources import paths
from fleetlake.sources.layers import Lake, read_table, stored_days
from tests.conftest import at, rows_of


def parquet_files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


@pytest.fixture
def three(make_predictions):
    return make_predictions(
        (1, "2025-08-15 10:00:00", 1, 7, 50, "10:15"),
        (2, "2025-08-15 10:00:00", 1, 7, 50, "10:15"),  # copy of 1
        (3, "2025-08-16 10:00:00", 1, 8, 50, "10:15"),
    )


def test_append_twice_is_append_once(spark, tmp_path, three):
    path = str(tmp_path / "t")
    assert appending.idempotent_append(three, path, "predictions") == 2
    first = rows_of(read_table(spark, path, "predictions"))
    assert [r[0] for r in first] == [1, 3]
    assert appending.idempotent_append(three, path, "predictions") == 0
    assert rows_of(read_table(spark, path, "predictions")) == first


def test_append_keeps_what_is_stored(spark, tmp_path, make_positions):
    path = str(tmp_path / "t")
    old = make_positions((9, "2025-08-15 10:00:00", 7, "A", 1.0, 1.0))
    new = make_positions(
        (1, "2025-08-15 10:00:00", 7, "B", 2.0, 2.0), (2, "2025-08-15 10:05:00", 7, "B", 2.0, 2.0)
    )
    appending.idempotent_append(old, path, "positions")
    assert appending.idempotent_append(new, path, "positions") == 1
    assert rows_of(read_table(spark, path, "positions"), "id", "line_code") == [(2, "B"), (9, "A")]


def test_null_keys_equal_nothing(spark, tmp_path, make_predictions):
    path = str(tmp_path / "t")
    rows = make_predictions(
        (1, "2025-08-15 10:00:00", 1, 7, None, "10:15"),
        (2, "2025-08-15 10:00:00", 1, 7, None, "10:15"),
        (3, "2025-08-15 10:00:00", 1, 7, 50, None),
    )
    assert appending.idempotent_append(rows, path, "predictions") == 3
    assert appending.idempotent_append(rows, path, "predictions") == 3
    assert read_table(spark, path, "predictions").count() == 6


def test_incomplete_rows_go_to_quarantine(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, at("2025-08-15 10:00:00"), 7, "A", 1.0, 1.0), (2, None, 7, "A", 1.0, 1.0), (3, at("2025-08-15 10:00:00"), 8, "A", None, 1.0)],
        "id long, collected_at timestamp_ntz, vehicle_id long, line_code string, lat double, lon double",
    )
    with pytest.raises(appending.IncompleteRows):
        appending.idempotent_append(rows, path, "positions")
    refused = str(tmp_path / "refused")
    assert appending.idempotent_append(rows, path, "positions", quarantine=refused) == 1
    assert rows_of(read_table(spark, path, "positions"), "id", "position_at") == [(1, None)]
    assert rows_of(spark.read.parquet(refused), "id") == [(2,), (3,)]
    assert appending.idempotent_append(rows.where("id = 2"), path, "positions", quarantine=refused) == 0
    with pytest.raises(Exception, match="has no collected_at"):
        appending.append(rows.where("id = 2"), path, "positions")


def test_rows_with_a_null_key_are_all_kept(spark, tmp_path, make_predictions):
    path = str(tmp_path / "t")
    same = [(None, "2025-08-15 10:00:00", 1, 7, None, "10:15")] * 3
    rows = make_predictions(*same, (None, "2025-08-15 10:00:00", 1, 7, 5, "10:15"), (None, "2025-08-15 10:00:00", 1, 7, 5, "10:15"))
    assert appending.idempotent_append(rows, path, "predictions", ["collected_at"]) == 4
    assert appending.idempotent_append(rows.where("stop_id = 5"), path, "predictions", ["collected_at"]) == 0


@pytest.mark.parametrize("step", range(4))
def test_a_broken_swap_loses_nothing(spark, tmp_path, make_positions, monkeypatch, step):
    """Each step of a replacement fails once; the job that runs again ends as if none had."""
    days = [(i, f"2025-08-{10 + i % 3} 10:0{i}:00", 1, "A", 0.0, 0.0) for i in range(6)]
    copies = [(10 + i, *r[1:]) for i, r in enumerate(days)]
    jobs = {
        "dedup": lambda p: dedup.remove_duplicates(spark, p, "positions"),
        "purge": lambda p: retention.purge(spark, p, "positions", at("2025-08-10 10:01:00")),
        "compact": lambda p: compaction.compact(make_positions((50, "2025-08-11 11:00:00", 5, "B", 0.0, 0.0)), p, "positions"),
        "replace": lambda p: appending.replace_table(make_positions((60, "2025-08-11 11:00:00", 5, "B", 0.0, 0.0)), p, "positions"),
    }
    for name, job in jobs.items():
        path, other = (str(tmp_path / f"{name}-{k}/t") for k in "ab")
        for p in (path, other):
            appending.append(make_positions(*days, *copies), p, "positions")
        job(other)
        calls = {"n": 0}
        real = {"move": paths.move, "remove": paths.remove}

        def failing(kind):
            def call(*arguments):
                inside = paths.OLD in "".join(map(str, arguments[1:])) or paths.STAGED in "".join(map(str, arguments[1:]))
                if inside and calls["on"]:
                    calls["n"] += 1
                    if calls["n"] == step + 1:
                        raise OSError("broken")
                return real[kind](*arguments)

            return call

        def broken_swap(*arguments, swap=paths.swap_in):
            calls["on"] = True
            return swap(*arguments)

        calls["on"] = False
        with monkeypatch.context() as patch:
            for kind in real:
                patch.setattr(paths, kind, failing(kind))
            for module in (appending, compaction, retention, dedup):
                patch.setattr(module, "swap_in", broken_swap)
            try:
                job(path)
            except OSError:
                pass
        job(path)
        assert rows_of(read_table(spark, path, "positions")) == rows_of(read_table(spark, other, "positions")), name


def test_append_reads_only_the_days_it_touches(spark, tmp_path, make_positions):
    path = str(tmp_path / "t")
    appending.append(
        make_positions(*[(d, f"2025-08-{d:02d} 10:00:00", 1, "A", 0.0, 0.0) for d in range(1, 11)]), path, "positions"
    )
    stored = read_table(spark, path, "positions").where(F.col("dt").isin([date(2025, 8, 3)])).select("vehicle_id")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "(dt#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<vehicle_id:bigint>" in plan


def unique_insert(table, rows, key_width):
    """Brute force: a row is refused if its key, free of NULLs, is there already."""
    for row in rows:
        key = row[1 : 1 + key_width]
        if None in key or all(key != r[1 : 1 + key_width] for r in table):
            table.append(row)
    return table


small = st.integers(1, 2)
prediction = st.tuples(
    st.sampled_from(["2025-08-15 10:00:00", "2025-08-16 10:00:00"]).map(at),
    small,
    small,
    st.none() | small,
    st.none() | st.sampled_from(["10:15", "10:20"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(prediction, max_size=12), min_size=2, max_size=2))
def test_append_equals_unique_insert(spark, tmp_path_factory, batches):
    path = str(tmp_path_factory.mktemp("append") / "t")
    expected, next_id = [], 0
    for batch in batches:
        rows = [(next_id + i, *r) for i, r in enumerate(batch)]
        next_id += len(rows)
        before = len(expected)
        unique_insert(expected, rows, 5)
        added = appending.idempotent_append(
            spark.createDataFrame(rows, schemas.PREDICTIONS), path, "predictions"
        )
        assert added == len(expected) - before
    stored = read_table(spark, path, "predictions").drop("dt")
    assert rows_of(stored) == sorted(expected, key=repr)


def test_plain_append_repeats(spark, tmp_path, three):
    path = str(tmp_path / "t")
    assert appending.append(three, path, "predictions") == 3
    assert appending.append(three, path, "predictions") == 3
    assert read_table(spark, path, "predictions").count() == 6


def test_replace_table_from_itself(spark, tmp_path, make_status):
    path = str(tmp_path / "fleet_status")
    rows = make_status(
        (1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0), (2, "2025-08-16 10:00:00", 2, "A", 0.0, 0.0)
    )
    assert appending.replace_table(rows, path, "fleet_status") == 2
    kept = read_table(spark, path, "fleet_status").where("vehicle_id = 2")
    assert appending.replace_table(kept, path, "fleet_status") == 1
    assert rows_of(read_table(spark, path, "fleet_status"), "id") == [(2,)]
    assert stored_days(spark, path) == {"2025-08-16"}


def test_conform_adds_and_drops_columns(spark):
    rows = spark.range(1).select(F.lit("x").alias("extra"), F.lit(5).alias("vehicle_id"))
    conformed = appending.conform(rows, "positions")
    assert conformed.columns == schemas.POSITIONS.names
    assert conformed.first()["vehicle_id"] == 5 and conformed.first()["lat"] is None


def test_create_tables_twice(spark, tmp_path, make_positions):
    for _ in range(2):
        tables = appending.create_tables(spark, str(tmp_path / "lake"), "fleet_test")
    assert tables == [f"fleet_test.{t}" for t in schemas.TABLES]
    positions = spark.table("fleet_test.positions")
    assert positions.columns == [*schemas.POSITIONS.names, "dt"]
    assert positions.schema["collected_at"].dataType == schemas.POSITIONS["collected_at"].dataType
    rows = make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0))
    appending.append(rows, str(tmp_path / "lake/bronze/positions"), "positions")
    appending.create_tables(spark, str(tmp_path / "lake"), "fleet_test")
    assert spark.table("fleet_test.positions").count() == 1


def test_compact_day_twice(spark, tmp_path, make_positions):
    path = str(tmp_path / "silver")
    day = date(2025, 8, 15)
    rows = make_positions(
        (1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0), (2, "2025-08-16 00:00:00", 1, "A", 0.0, 0.0)
    )
    for _ in range(2):
        assert compaction.compact(rows, path, "positions", day) == 1
        assert rows_of(read_table(spark, path, "positions"), "id", "dt") == [(1, day)]
        assert compaction.verify_day(spark, path, "positions", day) == 1


def test_compact_merges_into_its_day(spark, tmp_path, make_positions):
    path = str(tmp_path / "silver")
    compaction.compact(
        make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0), (2, "2025-08-16 10:00:00", 1, "A", 0.0, 0.0)),
        path,
        "positions",
    )
    compaction.compact(make_positions((3, "2025-08-16 11:00:00", 1, "A", 0.0, 0.0)), path, "positions")
    assert rows_of(read_table(spark, path, "positions"), "id") == [(1,), (2,), (3,)]
    assert rows_of(compaction.partition_counts(spark, path, "positions"), "n") == [(1,), (2,)]


def test_compact_nothing(spark, tmp_path, make_positions):
    path = str(tmp_path / "silver")
    assert compaction.compact(make_positions(), path, "positions") == 0
    rows = make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0))
    assert compaction.compact(rows, path, "positions", date(2025, 8, 14)) == 0
    assert parquet_files(path) == []
    assert compaction.partition_counts(spark, path, "positions").count() == 0


def test_compact_without_duplicates(spark, tmp_path, three):
    path = str(tmp_path / "silver")
    assert compaction.compact(three, path, "predictions", drop_duplicates=True) == 2
    assert rows_of(read_table(spark, path, "predictions"), "id") == [(1,), (3,)]


def test_a_large_day_is_not_one_task(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = spark.range(0, 200_000, numPartitions=8).selectExpr(
        "id", "timestamp_ntz'2025-08-15 10:00:00' as collected_at", "id as vehicle_id",
        "cast(null as string) as line_code", "rand(1) as lat", "rand(2) as lon",
        "cast(null as timestamp_ntz) as position_at",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        assert compaction.compact(rows, path, "positions", date(2025, 8, 15)) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(parquet_files(path)) > 3
    assert read_table(spark, path, "positions").select("id").distinct().count() == 200_000


def test_compact_any_table(spark, tmp_path, make_status):
    path = str(tmp_path / "silver")
    rows = make_status((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0))
    assert compaction.compact(rows, path, "fleet_status") == 1


@pytest.fixture
def old_and_new(make_positions):
    return make_positions(
        (1, "2024-01-01 00:00:00", 1, "A", 0.0, 0.0),
        (2, "2025-08-08 09:59:59", 2, "A", 0.0, 0.0),
        (3, "2025-08-08 10:00:00", 3, "A", 0.0, 0.0),  # exactly at the limit
        (4, "2025-08-15 09:00:00", 4, "A", 0.0, 0.0),
    )


LIMIT = retention.cutoff(at("2025-08-15 10:00:00"))


def test_purge(spark, tmp_path, old_and_new):
    path = str(tmp_path / "t")
    appending.append(old_and_new, path, "positions")
    planned = retention.dry_run({"positions": old_and_new}, as_of=at("2025-08-15 10:00:00"))
    assert rows_of(planned) == [("positions", 2)]
    assert read_table(spark, path, "positions").count() == 4
    assert retention.purge(spark, path, "positions", LIMIT) == 2
    assert rows_of(read_table(spark, path, "positions"), "id") == [(3,), (4,)]
    assert stored_days(spark, path) == {"2025-08-08", "2025-08-15"}
    assert retention.purge(spark, path, "positions", LIMIT) == 0
    assert rows_of(read_table(spark, path, "positions"), "id") == [(3,), (4,)]


def test_purge_of_a_whole_boundary_day(spark, tmp_path, make_positions):
    path = str(tmp_path / "t")
    appending.append(make_positions((2, "2025-08-08 09:59:59", 2, "A", 0.0, 0.0)), path, "positions")
    assert retention.purge(spark, path, "positions", LIMIT) == 1
    assert stored_days(spark, path) == set()


def test_purge_of_nothing(spark, tmp_path):
    assert retention.purge(spark, str(tmp_path / "absent"), "positions", LIMIT) == 0


def test_purge_keeps_what_is_not_archived(spark, tmp_path, old_and_new):
    path, archive = str(tmp_path / "t"), str(tmp_path / "silver")
    appending.append(old_and_new, path, "positions")
    assert retention.purge(spark, path, "positions", LIMIT, archive_path=archive) == 0
    compaction.compact(old_and_new, archive, "positions", date(2024, 1, 1))
    assert retention.purge(spark, path, "positions", LIMIT, archive_path=archive) == 1
    assert rows_of(read_table(spark, path, "positions"), "id") == [(2,), (3,), (4,)]


def test_dry_run_counts_back_from_the_newest_row(old_and_new):
    found = retention.dry_run({"positions": old_and_new, "empty": old_and_new.where("false")})
    assert rows_of(found) == [("empty", 0), ("positions", 1)]


def test_backfill_twice(spark, tmp_path, three, old_and_new):
    lake = Lake(str(tmp_path))
    sources = {"positions": old_and_new, "predictions": three}
    for _ in range(2):
        found = backfill.backfill(spark, sources, lake)
        assert rows_of(found) == [("positions", 4, 4), ("predictions", 3, 2)]
    assert backfill.backfill(spark, {"positions": old_and_new.where("false")}, lake).count() == 0


def test_lineage(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert lineage.record_run(spark, path, "collect_one", "positions", "bronze", 42, "ok", at("2025-08-15 10:00:00"))
    assert lineage.record_run(spark, path, "collect_one", "positions", "bronze", 7, "alert", at("2025-08-15 11:00:00"))
    assert lineage.record_run(spark, path, "other", "positions", "silver", run_timestamp=at("2025-08-15 09:00:00"))
    audit = read_table(spark, path, "lineage_audit")
    recent = [tuple(r) for r in lineage.recent_runs(audit, 2).collect()]
    assert recent == [
        ("collect_one", "bronze", 7, "alert", at("2025-08-15 11:00:00")),
        ("collect_one", "bronze", 42, "ok", at("2025-08-15 10:00:00")),
    ]
    assert rows_of(lineage.last_run_per_asset(audit), "asset_name", "row_count") == [("collect_one", 7), ("other", 0)]


def test_lineage_never_raises(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    assert lineage.record_run(spark, str(blocked / "audit"), "a", "t", "bronze") is False
    assert lineage.record_run(spark, str(tmp_path / "audit"), "a", "t", "bronze", 1, "unheard of") is False
