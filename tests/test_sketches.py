from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.operators import sketches
from tests.conftest import rows_of

DAYS = "date_add(date '2025-08-01', cast(id % 10 as int)) as dt"


def test_spans_are_united_within_the_stated_error(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rows = spark.range(400_000).selectExpr(DAYS, "id * 7919 % 150001 as vehicle_id", "cast(id % 37 as string) as line")
    sketches.store_sketches(rows, path, ["vehicle_id", "line"])
    stored = sketches.read_sketches(spark, path)
    for span in (None, F.col("dt") <= F.lit("2025-08-04").cast("date")):
        found = {r["column"]: r for r in sketches.distinct_estimate(stored, span).collect()}
        for true in sketches.distinct_exact(rows, ["vehicle_id", "line"], span).collect():
            one = found[true["column"]]
            assert one["rows"] == true["rows"]
            assert abs(one["estimate"] - true["exact"]) <= 4 * sketches.error() * true["exact"]
    assert found["line"]["estimate"] == 37


def test_a_day_is_replaced_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rows = spark.range(100).selectExpr(DAYS, "id as vehicle_id")
    sketches.store_sketches(rows, path, ["vehicle_id"])
    sketches.store_sketches(rows.where("dt = date '2025-08-02' and vehicle_id < 50"), path, ["vehicle_id"])
    stored = sketches.read_sketches(spark, path)
    assert rows_of(sketches.distinct_estimate(stored), "rows", "estimate") == [(95, 95)]


def test_nulls_are_no_values_and_nothing_stored_gives_nothing(spark, tmp_path):
    path = str(tmp_path / "sketches")
    assert sketches.distinct_estimate(sketches.read_sketches(spark, path)).count() == 0
    rows = spark.range(100).selectExpr(DAYS, "if(id % 10 = 0, null, id) as vehicle_id", "cast(null as string) as line")
    sketches.store_sketches(rows, path, ["vehicle_id", "line"])
    stored = sketches.read_sketches(spark, path)
    assert rows_of(sketches.distinct_estimate(stored), "column", "estimate") == [("line", 0), ("vehicle_id", 90)]


def test_reading_a_span_touches_only_its_days(spark, tmp_path, capsys):
    path = str(tmp_path / "sketches")
    sketches.store_sketches(spark.range(100).selectExpr(DAYS, "id as vehicle_id"), path, ["vehicle_id"])
    stored = sketches.read_sketches(spark, path)
    sketches.distinct_estimate(stored, F.col("dt") <= F.lit("2025-08-04").cast("date")).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dt" in plan and "dt#" in plan
