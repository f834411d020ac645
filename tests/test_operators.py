from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathgauge.operators import (
    average_rank_desc,
    interpolate_yearly,
    salted_join,
    stack_named,
    stack_same,
    strict_pivot,
    unpivot_years,
)


def test_unpivot_keeps_missing_cells_and_picks_years(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "k string, _2022 double, X_2023 double")
    assert rows(unpivot_years(df, "v")) == [("a", 2022, 1.0), ("a", 2023, None)]
    assert rows(unpivot_years(df, "v", years=[2023])) == [("a", 2023, None)]


def test_unpivot_of_some_years_reads_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame([("a", 1.0, 2.0)], "k string, _2022 double, _2023 double").write.parquet(path)
    long = unpivot_years(spark.read.parquet(path), "v", years=[2023])
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "_2023" in plan and "_2022" not in plan


def test_strict_pivot(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", None), ("b", "x", 2.0)], "k string, n string, v double"
    )
    got = strict_pivot(df, ["k"], "n", "v", ["x", "y"])
    assert rows(got) == [("a", 1.0, None), ("b", 2.0, None)]


@pytest.mark.parametrize("second", [1.0, 2.0, None])
def test_strict_pivot_rejects_a_second_row(spark, second):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", second)], "k string, n string, v double")
    with pytest.raises(Exception, match="more than one row"):
        strict_pivot(df, ["k"], "n", "v", ["x"]).collect()


def test_strict_pivot_of_distinct_rows(spark):
    same = spark.createDataFrame([("a", "x", 1), ("a", "x", 1)], "k string, n string, v int")
    assert rows(strict_pivot(same, ["k"], "n", "v", ["x"], distinct_rows=True)) == [("a", 1)]
    two = spark.createDataFrame([("a", "x", 1), ("a", "x", 0)], "k string, n string, v int")
    with pytest.raises(Exception, match="more than one row"):
        strict_pivot(two, ["k"], "n", "v", ["x"], distinct_rows=True).collect()


def test_strict_pivot_can_reject_unlisted_names(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "z", 1)], "k string, n string, v int")
    assert rows(strict_pivot(df, ["k"], "n", "v", ["x"])) == [("a", 1)]
    with pytest.raises(Exception, match="unlisted name"):
        strict_pivot(df, ["k"], "n", "v", ["x"], reject_other=True).collect()


def test_interpolate(spark):
    df = spark.createDataFrame(
        [
            ("a", 2020, 10.0),
            ("a", 2022, None),
            ("a", 2024, 30.0),
            ("b", 2020, None),
            ("b", 2021, 5.0),
            ("b", 2023, None),
            ("c", 2021, 7.0),
        ],
        "k string, year int, value double",
    )
    assert rows(interpolate_yearly(df, ["k"])) == [
        ("a", 2020, 10.0),
        ("a", 2021, 15.0),
        ("a", 2022, 20.0),
        ("a", 2023, 25.0),
        ("a", 2024, 30.0),
        ("b", 2020, None),
        ("b", 2021, 5.0),
        ("b", 2022, None),
        ("b", 2023, None),
        ("c", 2021, 7.0),
    ]


def test_interpolate_rejects_a_year_given_twice(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2020, 2.0)], "k string, year int, value double")
    with pytest.raises(Exception, match="given twice"):
        interpolate_yearly(df, ["k"]).collect()


def test_interpolate_shuffles_once(spark):
    df = spark.createDataFrame([("a", 2020, 1.0)], "k string, year int, value double")
    plan = interpolate_yearly(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_a_plain_one(spark, how):
    # One key holds a third of all rows; some keys have no match.
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).cast("int").alias("k")
    )
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 30)], "k int, v string")
    plain = facts.join(table, ["k"], how)
    salted = salted_join(facts, table, ["k"], how, spread_by=["id"], salts=7)
    assert plain.columns == salted.columns
    assert rows(plain) == rows(salted)


def test_stack(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert rows(stack_same(a, b)) == [(1, "x"), (2, "y")]
    assert rows(stack_named({"a": a, "c": c}, ["a", "c"])) == [(1, "x"), (3, None)]
    with pytest.raises(Exception):
        stack_same(a, c).collect()
    with pytest.raises(KeyError):
        stack_named({"a": a}, ["z"])


def brute_rank(values):
    """n + 1 minus the ascending rank of each known score, ties averaged."""
    known = sorted(v for v in values if v is not None)
    counts = Counter(known)
    result = {}
    for v in counts:
        ascending = known.index(v) + (counts[v] + 1) / 2
        result[v] = len(values) + 1 - ascending
    return [None if v is None else result[v] for v in values]


def check_rank(spark, data):
    df = spark.createDataFrame(data, "g string, name string, s double").repartition(5)
    got = {(r.g, r.name): r.rank for r in average_rank_desc(df, "g", "s", "name").collect()}
    want = {}
    for group in {g for g, _, _ in data}:
        members = [(n, s) for g, n, s in data if g == group]
        for (name, _), rank in zip(members, brute_rank([s for _, s in members])):
            want[group, name] = rank
    assert got == want


def test_rank_with_ties_and_missing_scores(spark):
    check_rank(spark, [("p", "a", 1.0), ("p", "b", 2.0), ("p", "c", 2.0), ("p", "d", None), ("q", "a", 0.0)])


def test_rank_when_one_score_fills_many_partitions(spark):
    generator = random.Random(7)
    data = [("p", f"c{i:04d}", 0.25 if i % 3 else generator.uniform(-1, 1)) for i in range(900)]
    data += [("q", f"c{i:04d}", generator.choice([None, 0.5, -0.5, 0.1])) for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_rank(spark, data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.sampled_from([None, -1.0, 0.0, 0.5, 2.0])), min_size=1, max_size=40))
def test_rank_against_brute_force(spark, drawn):
    check_rank(spark, [(g, f"c{i:02d}", s) for i, (g, s) in enumerate(drawn)])
