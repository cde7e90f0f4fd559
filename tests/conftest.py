from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlake import schemas
from fleetlake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        "4",
        4,
        **{
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def make_positions(spark):
    """Positions from (id, collected_at, vehicle, line, lat, lon[, position_at])."""

    def make(*rows):
        full = [
            (r[0], at(r[1]), *r[2:6], at(r[6]) if len(r) > 6 and r[6] else None) for r in rows
        ]
        return spark.createDataFrame(full, schemas.POSITIONS)

    return make


@pytest.fixture
def make_predictions(spark):
    """Predictions from (id, collected_at, line_id, vehicle, stop, predicted_at)."""

    def make(*rows):
        return spark.createDataFrame([(r[0], at(r[1]), *r[2:]) for r in rows], schemas.PREDICTIONS)

    return make


@pytest.fixture
def make_status(spark):
    """Fleet status from (id, analyzed_at, vehicle, line, lat, lon[, stop])."""

    def make(*rows):
        full = [(r[0], at(r[1]), *r[2:6], None, r[6] if len(r) > 6 else None, None) for r in rows]
        return spark.createDataFrame(full, schemas.FLEET_STATUS)

    return make


def rows_of(df, *columns):
    """Sorted tuples of ``columns`` (all by default)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
