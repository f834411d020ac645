"""Tables placed by company id, and tables in order of it whose scan passes over what a filter leaves out."""

from __future__ import annotations

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pathgauge.params import profile
from pathgauge.plans import connect as conn
from pathgauge.plans import production as prod
from pathgauge.plans import score
from pathgauge.sources.layout import read_placed, store_placed
from pathgauge.sources.stages import store


@pytest.fixture
def shuffle_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    """Rows that the scan of a plan without a shuffle hands on, after row groups and pages are passed over."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.length() == 1
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def connected_rows(spark):
    """Power plans of 40 companies in two sources, a company null included."""
    techs = F.array(*[F.lit(t) for t in ("CoalCap", "RenewablesCap", "GasCap")])
    return (
        spark.range(41)
        .select(F.when(F.col("id") < 40, F.col("id")).alias("id"))
        .withColumn("technology", F.explode(techs))
        .withColumn("year", F.explode(F.array(F.lit(2022), F.lit(2027))))
        .withColumn("scenario_source", F.explode(F.array(F.lit("WEO2022"), F.lit("it's other"))))
        .select(
            "id",
            F.lit(conn.MARKET).alias("equity_market"),
            "scenario_source",
            F.lit("NZE_2050").alias("scenario"),
            F.lit(conn.GLOBAL).alias("scenario_geography"),
            F.lit("Power").alias("ald_sector"),
            "technology",
            "year",
            (F.col("id") * 3 + F.col("year") - F.length("technology")).cast("double").alias("plan_tech_prod"),
            (F.col("id") * 2 + F.col("year") + 5).cast("double").alias("scen_tech_prod"),
        )
    )


def bridge_rows(spark):
    return spark.range(60).select(
        F.concat(F.lit("Company "), "id").alias("company_name"), F.col("id").alias("company_id"), F.lit("Power").alias("sector_assessed")
    )


def test_scores_from_placed_tables_shuffle_nothing_by_id(spark, tmp_path, shuffle_joins):
    params = profile("2022Q2")
    plain, listed = connected_rows(spark), bridge_rows(spark)
    placed = conn.store_placed_per_source(plain, 6, str(tmp_path / "connected"))
    bridge = conn.store_placed_bridge(listed, 6, str(tmp_path / "name_bridge"))
    by_id = re.compile(r"Exchange hashpartitioning\([^)]*\bid#")
    for made in (score.company_scores, lambda *a: score.with_sector_totals(score.paired_years(*a), params)):
        got, expected = made(placed, bridge, params), made(plain, listed, params)
        assert not by_id.search(plan(got)) and "SortMergeJoin" in plan(got)
        assert by_id.search(plan(expected))
        assert rows(got) == rows(expected) and got.count() >= 40
    one = conn.assessed(placed, params)
    assert "scenario_source=WEO2022" not in plan(one) and rows(one) == rows(conn.assessed(plain, params))


def test_placed_tables_are_read_again_and_replaced_in_part(spark, tmp_path):
    path = str(tmp_path / "it's one")
    df = connected_rows(spark)
    stored = store_placed(df, "t", by="id", buckets=4, partition_by="scenario_source", path=path)
    assert rows(stored, *df.columns) == rows(df) == rows(read_placed(spark, path), *df.columns)
    other = "scenario_source = 'WEO2022'"
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "it's one").rglob("*.parquet") if "WEO2022" not in str(p)}
    # Another number of buckets is not taken over: the kept files have the old one.
    new = df.where(other).withColumn("plan_tech_prod", F.lit(1.0))
    stored = store_placed(new, "t", by="id", buckets=9, partition_by="scenario_source", path=path, keep_other=True)
    assert files and all(p.stat().st_mtime_ns == at for p, at in files.items())
    assert rows(stored, *df.columns) == rows(df.where(f"not ({other})").union(new))
    # A whole write leaves nothing of what was there.
    stored = store_placed(new, "t", by="id", buckets=9, partition_by="scenario_source", path=path)
    assert rows(read_placed(spark, path), *df.columns) == rows(new) == rows(stored, *df.columns)
    empty = store_placed(df.limit(0), "t", by="id", buckets=3, path=str(tmp_path / "empty"))
    assert empty.count() == 0 and read_placed(spark, str(tmp_path / "empty")).columns == df.columns
    with pytest.raises(FileNotFoundError):
        read_placed(spark, str(tmp_path / "none"))


def production(spark, companies=6_000):
    """Two assets per company, but a third of all rows of one company."""
    ids = spark.range(companies).withColumn("company_id", F.explode(F.array(F.col("id") * 7, F.when(F.col("id") % 2 == 0, F.lit(77)).otherwise(F.col("id") * 7))))
    made = ids.select(
        "company_id",
        F.concat(F.lit("Company "), "company_id").alias("company_name"),
        F.lit("Power").alias("sector"),
        F.lit("DE").alias("asset_country"),
        F.concat(F.lit("Tech "), "id").alias("technology"),
        F.lit("MW").alias("unit"),
        F.lit(0.5).alias("emissions_factor"),
        F.col("id").cast("double").alias("_2022"),
    )
    return store(made, "production")


def test_scope_reaches_the_row_groups(spark, tmp_path):
    wide = production(spark)
    ordered = prod.masterdata(wide, (), ordered=True)
    hashed = prod.masterdata(wide, ())
    assert plan(ordered).count("Exchange") == plan(hashed).count("Exchange")
    options = {"blooms": ("id",), "row_group_bytes": 4_096}
    table = store(ordered, "masterdata", path=str(tmp_path / "m"), **options)
    assert rows(table) == rows(hashed)
    total = table.count()
    scanned = []
    for n in (1, 5, 50):
        bridge = spark.range(n).select((F.col("id") * (42_000 // 7 // n) * 7).alias("company_id"))
        ids = conn.listed_ids(bridge)
        scope = conn.in_scope(table, bridge, ids=ids)
        assert "PushedFilters: [In(id" in plan(scope).replace("IsNotNull(id), ", "") or n == 1
        assert "Join" not in plan(scope)
        assert rows(scope) == rows(conn.in_scope(table, bridge))
        scanned.append(rows_scanned(conn.in_scope(table, bridge, ids=ids)))
    # What is read grows with the scope and stays far below the whole.
    assert scanned[0] < scanned[1] < scanned[2] < total and scanned[0] < total / 10
    # Ids between those that occur: ranges do not tell, Bloom filters and dictionaries do.
    missing = [7 * k + 3 for k in range(0, 6_000, 40)]
    assert rows_scanned(table.where(F.col("id").isin(*missing))) < total / 10


def test_a_hot_company_is_split(spark):
    sizes = prod.masterdata(production(spark), (), ordered=True).groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") == 77).alias("hot")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.n, r.hot) for r in sizes.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(hot for _, hot in got) == 3_001 and sum(1 for _, hot in got if hot) > 1
    assert max(n for n, _ in got) < 2 * sum(n for n, _ in got) / len(got)


def test_a_long_list_is_joined(spark):
    bridge = spark.range(10).select(F.col("id").alias("company_id"))
    assert conn.listed_ids(bridge, most=10) == list(range(10)) and conn.listed_ids(bridge, most=9) is None
    facts = spark.range(20)
    assert rows(conn.in_scope(facts, bridge, ids=None)) == rows(conn.in_scope(facts, bridge, ids=conn.listed_ids(bridge)))
    nothing = bridge.limit(0)
    assert conn.in_scope(facts, nothing, ids=conn.listed_ids(nothing)).count() == 0
