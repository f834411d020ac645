from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pathgauge.functions.semantics import (
    first_match,
    floor_at_zero,
    if_else,
    merge_weighted_terms,
    ratio,
    recode,
    sum0,
    text_or,
    weighted_mean,
    weighted_mean_from_terms,
    weighted_terms,
)


def one(df):
    return df.collect()[0][0]


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert one(df.agg(sum0("x"))) == 0.0
    assert one(df.limit(0).agg(sum0("x"))) == 0.0


def test_if_else_is_unknown_when_the_condition_is(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    got = [r[0] for r in df.select(if_else(F.col("x") > 0, F.lit("yes"), F.lit("no"))).collect()]
    assert got == ["yes", "no", None]


def test_first_match_skips_unknown_rules(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with_default = first_match([("x > 0", F.lit("a"))], F.lit("rest"))
    without = first_match([("x > 0", F.lit("a"))])
    assert [tuple(r) for r in df.select(with_default, without).collect()] == [("a", "a"), ("rest", None)]


def test_ratio_and_floor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.5, None]
    values = spark.createDataFrame([(-2.0,), (0.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in values.select(floor_at_zero("x")).collect()] == [0.0, 0.0, 3.0, None]


def test_recode_keeps_or_drops_other_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    got = df.select(recode("x", {"a": "A"}, keep_other=True), recode("x", {"a": "A"}, keep_other=False))
    assert [tuple(r) for r in got.collect()] == [("A", "A"), ("b", None), (None, None)]


def test_text_or(spark):
    df = spark.createDataFrame([("N.A.",), (None,), ("Red",)], "x string")
    assert [r[0] for r in df.select(text_or("x", "none", ["N.A."])).collect()] == ["none", "none", "Red"]
    assert [r[0] for r in df.select(text_or("x", "none")).collect()] == ["N.A.", "none", "Red"]


WEIGHTED = [
    ([(1.0, 1.0), (3.0, 3.0)], 2.5),
    ([(None, 0.0), (2.0, 4.0)], 2.0),  # an unknown value of weight 0 does not count
    ([(None, 1.0), (2.0, 4.0)], None),
    ([(1.0, None), (2.0, 4.0)], None),
    ([(1.0, 0.0), (2.0, 0.0)], None),  # no weight at all
    ([(0.0, 5.0)], 0.0),
]


@pytest.mark.parametrize(("values", "expected"), WEIGHTED)
def test_weighted_mean(spark, values, expected):
    df = spark.createDataFrame([(x, w, i % 2) for i, (x, w) in enumerate(values)], "x double, w double, k int")
    assert one(df.agg(weighted_mean("x", "w"))) == expected
    assert one(df.select(weighted_mean("x", "w", Window.partitionBy(F.lit(1))))) == expected
    two_steps = df.groupBy("k").agg(*weighted_terms("x", "w")).agg(*merge_weighted_terms())
    assert one(two_steps.select(weighted_mean_from_terms())) == expected
