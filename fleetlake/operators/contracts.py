"""Row contracts of the layers, as named boolean columns.

A batch is never aborted: rows that break a rule are returned with the names of the
broken rules, for a quarantine table. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contracts.
MAX_LINE_LENGTH = 20
MAX_PREDICTION_LENGTH = 30
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

Rules = dict[str, Column]


def position_rules(
    min_vehicle: int = 1,
    lat_range: tuple[float, float] = (-90.0, 90.0),
    lon_range: tuple[float, float] = (-180.0, 180.0),
    max_line_length: int = MAX_LINE_LENGTH,
) -> Rules:
    """Time present, vehicle positive, coordinates in range, line short or absent.

    NaN sorts above every number, so it fails the range checks like any other overflow.
    """
    return {
        "time": F.col("collected_at").isNotNull(),
        "vehicle": F.col("vehicle_id") >= min_vehicle,
        "lat": F.col("lat").between(*lat_range),
        "lon": F.col("lon").between(*lon_range),
        "line": _absent_or_short("line_code", max_line_length),
    }


def prediction_rules(max_prediction_length: int = MAX_PREDICTION_LENGTH) -> Rules:
    """Time present, line and vehicle positive, predicted time short or absent."""
    return {
        "time": F.col("collected_at").isNotNull(),
        "line": F.col("line_id") > 0,
        "vehicle": F.col("vehicle_id") > 0,
        "predicted_at": _absent_or_short("predicted_at", max_prediction_length),
    }


def landed_rules(bronze: Rules) -> Rules:
    """The bronze contract for rows fresh from a snapshot: optional fields are readable or absent."""
    return {**bronze, "unreadable": F.col("unreadable").isNull()}


def silver_rules(bronze: Rules) -> Rules:
    """The bronze contract plus a day of the form YYYY-MM-DD."""
    return {**bronze, "dt": F.col("dt").cast("string").rlike(DAY_PATTERN)}


def _absent_or_short(column: str, limit: int) -> Column:
    return F.col(column).isNull() | (F.length(column) <= limit)


def is_valid(rules: Rules) -> Column:
    """True where every rule holds; a rule that cannot be evaluated counts as broken."""
    valid = F.lit(True)
    for rule in rules.values():
        valid = valid & F.coalesce(rule, F.lit(False))
    return valid


def broken_rules(rules: Rules) -> Column:
    """Names of the broken rules, each followed by a semicolon; empty for a valid row."""
    return F.concat(
        *[F.when(rule, F.lit("")).otherwise(F.lit(f"{name};")) for name, rule in rules.items()]
    )


def accepted(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(is_valid(rules))


def rejects(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows that break a rule, with ``reasons``."""
    return df.where(~is_valid(rules)).withColumn("reasons", broken_rules(rules))


def contract_summary(df: DataFrame, rules: Rules) -> DataFrame:
    """Total and valid row counts."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_valid(rules)).alias("valid")
    )
