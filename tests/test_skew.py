"""Hot keys: same results on the split path as on the plain one."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.operators import fleet
from fleetlake.operators.bunching import adjacent_distances
from fleetlake.operators.pick import first_per_key, keep_first, last_per_key
from fleetlake.operators.skew import broadcast_if_small, hot_keys, left_join_unique, task_count
from tests.conftest import rows_of


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def track(spark):
    """6,000 rows; vehicle 1, line A and one snapshot hold most of them."""
    i = F.col("id")
    hot = i % 3 != 0
    return spark.range(6000).select(
        i.alias("id"),
        F.when(hot, F.lit("2024-01-01 10:00:00"))
        .otherwise(F.lit("2024-01-01 11:00:00"))
        .cast("timestamp_ntz")
        .alias("analyzed_at"),
        F.when(hot, F.lit(1)).otherwise(i % 50).cast("bigint").alias("vehicle_id"),
        F.when(hot, F.lit("A")).otherwise(F.concat(F.lit("L"), (i % 7).cast("string"))).alias("line_code"),
        # Many equal latitudes, so that the order is decided by longitude and id.
        (F.lit(-23.5) - (i * 17 % 40) / 1e3).alias("lat"),
        (F.lit(-46.6) - (i * 29 % 25) / 1e3).alias("lon"),
    )


def test_hot_keys_are_fewer_than_tasks(spark, track):
    hot = hot_keys(track, ["vehicle_id"], min_rows=1)
    assert [(r["vehicle_id"]) for r in hot] == [1]
    assert len(hot) < task_count(track)
    assert hot[0]["_splits"] == 6  # two thirds of the rows over twice the four tasks, rounded up


def test_small_keys_are_never_hot(track):
    assert hot_keys(track, ["vehicle_id"]) == []


def test_all_rows_in_one_key(spark):
    df = spark.range(100).select(F.lit(7).alias("k"))
    assert [r["_splits"] for r in hot_keys(df, ["k"], min_rows=1)] == [8]


def test_no_rows(spark):
    assert hot_keys(spark.range(0).select(F.col("id").alias("k")), ["k"], min_rows=1) == []


def test_null_key_can_be_hot(spark):
    fact = spark.range(1000).select(
        "id", F.when(F.col("id") % 4 == 0, F.col("id") % 10).alias("k")
    )
    lookup = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 100).alias("v"))
    assert [r["k"] for r in hot_keys(fact, ["k"], min_rows=1)] == [None]
    split = left_join_unique(fact, lookup, ["k"], ["id"], 1, max_broadcast_bytes=0)
    assert rows_of(split, "id", "v") == rows_of(fact.join(lookup, "k", "left"), "id", "v")


def test_split_join_equals_plain_join(spark, track):
    lookup = spark.range(0, 60, 2).select(F.col("id").alias("vehicle_id"), (F.col("id") + 5).alias("stop"))
    lookup = lookup.unionByName(spark.createDataFrame([(1, 99)], "vehicle_id long, stop long"))
    plain = track.join(lookup, "vehicle_id", "left")
    for limit in (0, 10**6):
        split = left_join_unique(track, lookup, ["vehicle_id"], ["id"], 1, limit)
        assert split.count() == 6000
        assert rows_of(split, "id", "stop") == rows_of(plain, "id", "stop")


def test_split_join_spreads_the_hot_key(spark, track):
    lookup = spark.createDataFrame([(1, 99)], "vehicle_id long, stop long")
    split = executed(left_join_unique(track, lookup, ["vehicle_id"], ["id"], 1, 0))
    assert "xxhash64" in split and "_salt" in split


def test_small_lookup_spares_the_fact_table_its_shuffle(spark, track):
    lookup = spark.createDataFrame([(1, 99)], "vehicle_id long, stop long")
    plan = executed(left_join_unique(track, lookup, ["vehicle_id"], ["id"], 1))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def brute_force_pairs(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r["analyzed_at"], r["line_code"]), []).append(r)
    pairs = []
    for key, members in groups.items():
        members.sort(key=lambda r: (r["lat"], r["lon"], r["id"], r["vehicle_id"]))
        pairs += [
            (*key, a["vehicle_id"], b["vehicle_id"]) for a, b in zip(members, members[1:])
        ]
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("min_rows", [1, 10**9])
def test_neighbours_equal_brute_force(track, min_rows):
    found = adjacent_distances(
        track, ["analyzed_at", "line_code"], "id", "vehicle_id", min_hot_rows=min_rows
    )
    assert rows_of(found, "analyzed_at", "line_code", "vehicle_id", "next_vehicle_id") == (
        brute_force_pairs(track.collect())
    )


def test_chunked_distances_equal_window(track):
    plain = fleet.bunched_events(track, 200)
    split = fleet.bunched_events(track, 200, min_hot_rows=1)
    assert plain.count() > 0
    assert rows_of(plain) == rows_of(split)


def test_kpis_on_the_split_path(track):
    assert rows_of(fleet.fleet_kpis(track)) == rows_of(fleet.fleet_kpis(track, min_hot_rows=1))


@pytest.mark.parametrize(("order", "unique"), [(["id"], False), (["id"], True), (["analyzed_at", "id"], False)])
def test_pick_equals_window(track, order, unique):
    for picker, direction in ((first_per_key, F.asc), (last_per_key, F.desc)):
        window = Window.partitionBy("vehicle_id").orderBy(*[direction(c) for c in order])
        expected = track.withColumn("rn", F.row_number().over(window)).where("rn = 1")
        found = picker(track, ["vehicle_id"], order, ["id", "lat"], unique)
        assert rows_of(found) == rows_of(expected, "vehicle_id", "id", "lat")


def test_pick_moves_one_row_per_key_and_task(track):
    text = executed(last_per_key(track, ["vehicle_id"], ["analyzed_at", "id"], ["lat"]))
    assert "partial_max" in text and "Window" not in text


def test_tied_orders_take_whole_rows(spark):
    rows = spark.createDataFrame([(1, 5, "b", 1), (1, 5, "a", 2), (1, 6, "0", 0)], "k int, o int, x string, y int")
    assert rows_of(first_per_key(rows, ["k"], ["o"], ["x", "y"])) == [(1, "a", 2)]
    assert rows_of(last_per_key(rows.where("o = 5"), ["k"], ["o"], ["x", "y"])) == [(1, "b", 1)]


def test_fixed_width_picks_are_hashed(track):
    fast = last_per_key(track, ["vehicle_id"], ["id"], ["lat", "lon"], unique_order=True)
    assert "SortAggregate" not in executed(fast)
    assert "SortAggregate" not in executed(keep_first(track.select("vehicle_id", "id"), ["vehicle_id"], ["id"]))


def test_copies_of_one_key_collapse_before_the_shuffle(spark):
    rows = spark.range(5000).select("id", F.lit("k").alias("key"))
    kept = keep_first(rows, ["key"], ["id"])
    assert rows_of(kept, "key", "id") == [("k", 0)]
    assert "partial_min" in executed(kept)


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_only_when_small(spark):
    # The estimate of a Cartesian product is far above the ten rows it leaves.
    few = spark.range(1000).select("id").crossJoin(spark.range(100_000).select(F.col("id").alias("b")))
    few = few.where("id = b and id < 10").select("id")
    assert hinted(broadcast_if_small(few))
    assert not hinted(broadcast_if_small(few, max_bytes=20))
    assert not hinted(broadcast_if_small(spark.range(10)))  # the planner's own choice


def test_small_tables_are_not_counted(spark):
    assert hot_keys(spark.range(100).select(F.lit(1).alias("k")), ["k"], min_rows=1000) == []
