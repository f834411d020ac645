"""Emission intensity of steel, cement and aviation companies against a 2030 benchmark."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import (
    first_match,
    merge_weighted_terms,
    ratio,
    weighted_mean_from_terms,
    weighted_terms,
)
from pathgauge.operators.lookup import fixed_lookup
from pathgauge.params import Params
from pathgauge.plans.connect import in_scope
from pathgauge.plans.names import display_name

SCORE_COLUMNS = (
    "ald_sector",
    "company_name",
    "year",
    "emission_intensity_sector",
    "scenario",
    "benchmark_year",
    "value",
    "alignment_metric",
    "alignement_classement",
    "traffic_light",
)


def intensity_scope(facts: DataFrame, params: Params) -> DataFrame:
    """Rows that count: the three sectors in the reference year, without their side processes."""
    return facts.where(
        F.col("ald_sector").isin(*refdata.INTENSITY_SECTORS)
        & ~F.col("technology").isin(*refdata.INTENSITY_EXCLUDED_TECHS)
        & (F.col("year") == params.reference_year)
    )


def company_intensity(
    facts: DataFrame, bridge: DataFrame, params: Params, ids: Sequence[int] | None = None
) -> DataFrame:
    """Production-weighted mean factor per listed company, pooled over its ids.

    The terms of the mean are summed per id before the name join, so the join
    handles one row per id, sector and year however many assets an id has. ``ids``
    as in ``connect.in_scope``.
    """
    per_id = (
        in_scope(intensity_scope(facts, params), bridge, ids=ids)
        .groupBy("id", "year", "ald_sector")
        .agg(*weighted_terms("ald_emissions_factor", "ald_production", exact=params.exact_sums))
    )
    listed = bridge.withColumnRenamed("company_id", "id")
    return (
        per_id.join(listed, "id", "inner")
        .groupBy("company_name", "year", "ald_sector")
        .agg(*merge_weighted_terms(exact=params.exact_sums))
        .select(
            "company_name",
            "year",
            "ald_sector",
            weighted_mean_from_terms().alias("emission_intensity_sector"),
        )
    )


def _by_sector(values: dict[str, object]) -> Column:
    return first_match([(F.col("ald_sector") == sector, F.lit(v)) for sector, v in values.items()])


def score_intensity(intensity: DataFrame) -> DataFrame:
    """Gap to the benchmark, its class and its traffic light.

    An intensity of 0 is infinitely far on the good side. An unknown gap falls
    through to the last class.
    """
    spark = intensity.sparkSession
    measured = F.col("emission_intensity_sector")
    gap = F.when((measured == 0) & (F.col("value") > 0), F.lit(math.inf)).otherwise(
        ratio(F.col("value") - measured, measured)
    )
    near = F.col("alignment_metric") > _by_sector({s: b[0] for s, b in refdata.INTENSITY_BOUNDS.items()})
    mid = F.col("alignment_metric") > _by_sector({s: b[1] for s, b in refdata.INTENSITY_BOUNDS.items()})
    step = F.when(near, 0).when(mid, 1).otherwise(2)

    def label(position: int) -> Column:
        return _by_sector({s: names[position] for s, names in refdata.INTENSITY_CLASSES.items()})

    lights = F.array(*[F.lit(light) for light in refdata.INTENSITY_LIGHTS])
    return (
        fixed_lookup(intensity, refdata.intensity_benchmarks(spark), ["ald_sector"], "inner")
        .withColumn("alignment_metric", gap)
        .withColumn("_step", step)
        .withColumn("alignement_classement", F.array(label(0), label(1), label(2))[F.col("_step")])
        .withColumn("traffic_light", lights[F.col("_step")])
        .select(*SCORE_COLUMNS)
    )


def intensity_result(
    facts: DataFrame, bridge: DataFrame, params: Params, ids: Sequence[int] | None = None
) -> DataFrame:
    scored = score_intensity(company_intensity(facts, bridge, params, ids))
    return display_name(scored, refdata.INTENSITY_DISPLAY_NAMES)
