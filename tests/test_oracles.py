"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from testbed import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(entry_module.QUERIES) == set(entry_module.ORACLES)


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns[:2] == ["ald_sector", "company_name"]
    assert result.count() > 0


@pytest.mark.parametrize("name", list(entry_module.QUERIES))
def test_query(spark, db, name):
    count, problem, _, _ = compare.compare(spark, db, name, SF_DIR)
    assert problem == ""
    assert count > 0


@pytest.fixture
def nothing_is_small(spark):
    """No table is small enough for Spark to broadcast by its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


@pytest.mark.parametrize("name", ["agg_rank", "comm_plan", "traj_wide", "ei_score", "report_auto", "scenario_long"])
def test_query_when_nothing_is_small(spark, db, nothing_is_small, name):
    _, problem, _, _ = compare.compare(spark, db, name, SF_DIR)
    assert problem == ""
