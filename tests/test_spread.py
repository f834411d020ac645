"""The model's tables at size: how rows are placed over tasks, and what a stage holds."""

from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from testbed import model, queries

SUMS = ("prod_normalise", "masterdata", "hdv_recode", "stage_roundtrip", "ei_scope")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    nation = [(n, f"Nation {n}", n % 2) for n in range(4)]
    supplier = [(s, f"Supplier#{s:09d}", s % 4, 100.0 * (s % 3)) for s in range(40)]
    part = [
        (p, f"Brand#{p % 25 + 1}", model.PART_TYPES[p % len(model.PART_TYPES)], p % 50 + 1) for p in range(60)
    ]
    line = [
        (n % 60, n % 40, float(n % 7 + 1), "RAN"[n % 3], datetime.datetime(1995 + n % 7, 1 + n % 12, 1)) for n in range(2_000)
    ]
    made = {
        "region": [(0, "AMERICA"), (1, "ASIA")],
        "nation": nation,
        "supplier": supplier,
        "part": part,
        # A part or a supplier that no table has, and lines that come twice.
        "lineitem": line + line[:100] + [(None, 1, 1.0, "R", line[0][4]), (1, 99, 1.0, "R", line[0][4])],
    }
    for name, values in made.items():
        df = spark.createDataFrame(values, model.SCHEMAS[name])
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_spread_keeps_the_rows(spark, tables):
    assert rows(model.shipped(spark, tables, spread=True)) == rows(model.shipped(spark, tables)) != []


@pytest.mark.parametrize("name", SUMS)
def test_sums_by_company_are_spread(spark, tables, name, monkeypatch):
    """Few and small as the rows are, adaptive execution does not gather them in one task."""
    # A table that is written is read back in other partitions, so it's looked at before.
    monkeypatch.setattr(queries, "store", lambda df, *_, **__: df)
    found = queries.QUERIES[name](spark, tables)
    if name == "hdv_recode":
        found = queries.prod.recode_hdv(queries._masterdata(queries._assets(spark, tables)))
    tasks = found.select(F.spark_partition_id().alias("part")).distinct().count()
    assert tasks > 4


def test_tasks_grow_with_the_lines(spark, tables, tmp_path):
    def tasks():
        return model.shipped(spark, tables, spread=True).rdd.getNumPartitions()

    few = tasks()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert tasks() > few == model.TASKS_PER_SPLIT
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_production_is_kept_without_the_scenarios_columns(spark, tables):
    wide = queries._wide(spark, tables)
    assert spark.read.parquet(*wide.inputFiles()).columns == wide.columns
    assert rows(wide) == rows(queries._production(spark, tables)) != []
