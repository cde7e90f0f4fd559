"""Every registered query against its SQL counterpart on another engine."""

from __future__ import annotations

import os

import pytest

from fleetlake import registry
from tests.oracle_check import mismatch, oracle_connection

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sql, name):
    found = registry.QUERIES[name](spark, FOLDER).toPandas()
    expected = sql.execute(ORACLE[name]).df()
    assert len(expected) > 0
    assert mismatch(found, expected) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1000
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(registry.oracle_sql()) <= set(__spark_entry__.oracle_sql())
