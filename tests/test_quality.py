from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import quality
from tests.conftest import at, rows_of

DAY = "dt date"


def layer(spark, **days):
    rows = [(d[1:].replace("_", "-"),) for d, n in days.items() for _ in range(n)]
    return spark.createDataFrame(rows, "dt string").select(F.col("dt").cast("date"))


@pytest.mark.parametrize(
    ("bronze", "silver", "diff", "passed"),
    [
        (0, 0, 0.0, True),
        (2, 2, 0.0, True),
        (100, 95, 5.0, True),
        (100, 94, 6.0, False),
        (100, 106, 6.0, False),
        (0, 3, 100.0, False),
        (3, 0, 100.0, False),
        (1000, 949, 5.1, False),
    ],
)
def test_reconcile(spark, bronze, silver, diff, passed):
    found = quality.reconcile(
        layer(spark, _2025_08_15=bronze), layer(spark, _2025_08_15=silver)
    )
    assert rows_of(found) == [(bronze, silver, diff, passed)]


def test_reconcile_by_day_ignores_purged_days(spark):
    bronze = layer(spark, _2025_08_15=10, _2025_08_16=10, _2025_08_17=4)
    silver = layer(spark, _2025_08_01=50, _2025_08_15=10, _2025_08_16=7)
    found = quality.reconcile(bronze, silver, by_day=True)
    assert [(str(r[0]), *r[1:]) for r in sorted(found.collect())] == [
        ("2025-08-15", 10, 10, 0.0, True),
        ("2025-08-16", 10, 7, 30.0, False),
    ]
    assert quality.reconcile(bronze, silver).first()["passed"] is False


def test_reconcile_tolerance(spark):
    a, b = layer(spark, _2025_08_15=10), layer(spark, _2025_08_15=8)
    assert quality.reconcile(a, b, tolerance_pct=20).first()["passed"] is True


def test_freshness(make_positions):
    rows = make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0))
    tables = {"fresh": rows, "empty": rows.where("false")}
    assert rows_of(quality.freshness(tables, at("2025-08-15 11:00:00"))) == [
        ("empty", True, None),
        ("fresh", False, False),  # exactly sixty minutes
    ]
    stale = quality.freshness({"positions": rows}, at("2025-08-15 11:00:01"))
    assert rows_of(stale) == [("positions", False, True)]


def test_freshness_in_another_zone(spark, make_positions):
    rows = make_positions((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for as_of, stale in (("2025-08-15 11:00:00", False), ("2025-08-15 11:00:01", True)):
            found = quality.freshness({"positions": rows}, at(as_of))
            assert rows_of(found) == [("positions", False, stale)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_last_batch(make_positions):
    rows = make_positions(
        (1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0),
        (2, "2025-08-15 10:05:00", 1, "A", 0.0, 0.0),
        (3, "2025-08-15 10:05:00", 2, "A", 0.0, 0.0),
    )
    found = quality.last_batch({"positions": rows, "predictions": rows.where("false")})
    assert rows_of(found) == [("positions", 2), ("predictions", 0)]


def test_null_audit(make_positions):
    rows = make_positions(
        (1, "2025-08-15 10:00:00", 1, None, 0.0, 0.0),
        (2, "2025-08-15 10:05:00", 1, "A", 0.0, 0.0, "2025-08-15 10:05:00"),
    )
    found = quality.null_audit({"positions": (rows, ["line_code", "position_at"])})
    assert rows_of(found) == [
        ("positions_line_code_null", 1),
        ("positions_position_at_null", 1),
        ("positions_total", 2),
    ]
    assert rows_of(quality.table_counts({"a": rows, "b": rows.where("false")})) == [("a", 2), ("b", 0)]
