from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import contracts
from tests.conftest import at, rows_of

TIME = at("2025-08-13 10:00:00")
POSITION = "collected_at timestamp_ntz, vehicle_id long, line_code string, lat double, lon double, extra string"
PREDICTION = "collected_at timestamp_ntz, line_id long, vehicle_id long, stop_id long, predicted_at string"


@pytest.mark.parametrize(
    ("row", "reasons"),
    [
        ((TIME, 12345, "978M-10", -23.55, -46.63, "ignored"), ""),
        ((TIME, 1, None, 90.0, 180.0, None), ""),
        ((TIME, 1, "x" * 20, -90.0, -180.0, None), ""),
        ((TIME, 1, "ç" * 20, -90.0, -180.0, None), ""),  # characters, not bytes
        ((None, 1, None, 0.0, 0.0, None), "time;"),
        ((TIME, -1, None, 0.0, 0.0, None), "vehicle;"),
        ((TIME, 0, None, 0.0, 0.0, None), "vehicle;"),
        ((TIME, None, None, 0.0, 0.0, None), "vehicle;"),
        ((TIME, 1, "x" * 21, 0.0, 0.0, None), "line;"),
        ((TIME, 1, None, 100.0, 0.0, None), "lat;"),
        ((TIME, 1, None, float("nan"), 0.0, None), "lat;"),
        ((TIME, 1, None, None, 0.0, None), "lat;"),
        ((TIME, 1, None, 0.0, -180.1, None), "lon;"),
        ((None, 0, "x" * 21, 91.0, 181.0, None), "time;vehicle;lat;lon;line;"),
    ],
)
def test_positions(spark, row, reasons):
    df = spark.createDataFrame([row], POSITION)
    rules = contracts.position_rules()
    assert contracts.accepted(df, rules).count() == (reasons == "")
    assert [r["reasons"] for r in contracts.rejects(df, rules).collect()] == ([reasons] if reasons else [])


@pytest.mark.parametrize(
    ("row", "valid"),
    [
        ((TIME, 123, 45678, 9012, "2025-08-13T10:15:00"), True),
        ((TIME, 123, 45678, None, None), True),
        ((TIME, 123, 1, 1, "x" * 30), True),
        ((TIME, 123, 1, 1, "x" * 31), False),
        ((TIME, 123, 0, 1, None), False),
        ((TIME, 0, 1, 1, None), False),
        ((TIME, None, 1, 1, None), False),
        ((None, 1, 1, 1, None), False),
    ],
)
def test_predictions(spark, row, valid):
    df = spark.createDataFrame([row], PREDICTION)
    assert contracts.accepted(df, contracts.prediction_rules()).count() == valid


@pytest.mark.parametrize(
    ("day", "valid"),
    [("2025-08-13", True), ("13-08-2025", False), ("2025-8-13", False), (" 2025-08-13", False), (None, False)],
)
def test_silver_day(spark, day, valid):
    df = spark.createDataFrame([(TIME, 1, None, 0.0, 0.0, None)], POSITION).withColumn(
        "dt", F.lit(day).cast("string")
    )
    rules = contracts.silver_rules(contracts.position_rules())
    assert contracts.accepted(df, rules).count() == valid


def test_silver_day_of_a_partition(spark):
    df = spark.createDataFrame([(TIME, 1, 1, 1, None)], PREDICTION).withColumn("dt", F.to_date("collected_at"))
    assert contracts.accepted(df, contracts.silver_rules(contracts.prediction_rules())).count() == 1


def test_batch_is_not_aborted(spark):
    df = spark.createDataFrame(
        [(TIME, 123, "A", -23.55, -46.63, None), (TIME, 0, "B", -23.56, -46.64, None)], POSITION
    )
    rules = contracts.position_rules()
    assert rows_of(contracts.rejects(df, rules), "line_code", "reasons") == [("B", "vehicle;")]
    assert rows_of(contracts.contract_summary(df, rules)) == [(2, 1)]
    assert rows_of(contracts.contract_summary(df.where("false"), rules)) == [(0, 0)]
