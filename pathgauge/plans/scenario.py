"""Scenario pathways: raw datasets to targets per model geography."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathgauge import refdata, schemas
from pathgauge.functions.semantics import ratio, recode, total
from pathgauge.operators.interpolate import interpolate_yearly
from pathgauge.operators.union import stack_named, stack_same
from pathgauge.params import Params

SERIES_KEYS = ("source", "scenario", "sector", "technology", "scenario_geography", "indicator", "units")


def hdv_pathway(raw: DataFrame, params: Params) -> DataFrame:
    """Truck pathway in the shape of the raw scenarios; its own share columns are left out."""
    return raw.where(F.col("year") >= params.reference_year).select(
        F.lit(params.pathway_source).alias("source"),
        recode("scenario", refdata.PATHWAY_SCENARIOS, keep_other=False).alias("scenario"),
        F.lit("HDV").alias("sector"),
        recode("technology", refdata.PATHWAY_TECHS, keep_other=False).alias("technology"),
        F.col("scenario_region").alias("scenario_geography"),
        F.lit("#").alias("indicator"),
        F.col("unit").alias("units"),
        "year",
        "value",
    )


def add_market_share(df: DataFrame, reference_year: int, exact: bool = False) -> DataFrame:
    """Growth against the reference year: of the technology, and as a share of its sector.

    ``tmsr`` is the value over the technology's reference value; ``smsp`` is the
    change since then over the sector's reference total. The sector window comes
    first: its keys are a subset of the technology's, so both share one shuffle.
    """
    sector = ["source", "scenario", "scenario_geography", "sector"]
    at_start = F.when(F.col("year") == reference_year, F.col("value"))
    return (
        df.withColumn("_sector0", total(at_start, exact, Window.partitionBy(*sector)))
        .withColumn("_tech0", F.max(at_start).over(Window.partitionBy(*sector, "technology")))
        .withColumn("tmsr", ratio("value", "_tech0"))
        .withColumn("smsp", ratio(F.col("value") - F.col("_tech0"), F.col("_sector0")))
        .drop("_sector0", "_tech0")
    )


def format_targets(df: DataFrame, params: Params) -> DataFrame:
    """Model column names, and the share a company is expected to follow.

    Technologies to build out follow the sector share, all others their own ratio.
    """
    build_out = F.coalesce(F.col("technology").isin(*params.green_techs), F.lit(False))
    return df.withColumnsRenamed({"source": "scenario_source", "sector": "ald_sector"}).withColumn(
        "fair_share", F.when(build_out, F.col("smsp")).otherwise(F.col("tmsr") - 1)
    )


def scenario_input(
    datasets: Mapping[str, DataFrame], pathway: DataFrame, params: Params
) -> DataFrame:
    """All pathways, yearly from the reference year on, with shares."""
    raw = stack_named(datasets, params.scenario_datasets)
    yearly = stack_same(interpolate_yearly(raw, SERIES_KEYS), hdv_pathway(pathway, params))
    started = yearly.where(F.col("year") >= params.reference_year)
    shared = format_targets(add_market_share(started, params.reference_year, params.exact_sums), params)
    return shared.select(*schemas.SCENARIO_INPUT.fieldNames())


def bridge_geography(scenarios: DataFrame, bridge: DataFrame) -> DataFrame:
    """Rename each source's geographies to the model's; unlisted ones drop out."""
    mapping = bridge.withColumnsRenamed(
        {"source": "scenario_source", "scenario_geography_source": "scenario_geography"}
    )
    joined = scenarios.join(mapping, ["scenario_source", "scenario_geography"], "inner")
    return joined.drop("scenario_geography").withColumnRenamed(
        "scenario_geography_model", "scenario_geography"
    )


def scenario_long(
    scenarios: DataFrame, bridge: DataFrame, regions: DataFrame, params: Params
) -> DataFrame:
    """Targets per model geography within the run's sources, sectors and years.

    Rows of the truck pathway's source are also kept as they are: neither the
    bridge nor the filters apply to that copy. Both copies come out of one pass
    over the scenarios: each row offers up to two geographies.
    """
    known = regions.select(F.col("scenario_geography").alias("scenario_geography_model")).distinct()
    mapping = bridge.join(known, "scenario_geography_model", "left_semi").withColumnsRenamed(
        {"source": "scenario_source", "scenario_geography_source": "scenario_geography"}
    )
    in_run = (
        F.col("scenario_source").isin(*params.scenario_sources)
        & F.col("ald_sector").isin(*params.all_sectors)
        & F.col("year").between(params.reference_year, params.end_year)
    )
    offered = F.array_compact(
        F.array(
            F.when(in_run & F.col("scenario_geography_model").isNotNull(), F.struct("scenario_geography_model")),
            F.when(
                F.col("scenario_source") == params.pathway_source,
                F.struct(F.col("scenario_geography").alias("scenario_geography_model")),
            ),
        )
    )
    placed = (
        scenarios.join(mapping, ["scenario_source", "scenario_geography"], "left")
        .withColumn("_place", F.explode(offered))
        .withColumn("scenario_geography", F.col("_place.scenario_geography_model"))
    )
    # The sector is decided on the technology as it came in.
    doubled = refdata.DOUBLED_SUFFIX_RECODE
    unnamed_truck = (F.col("ald_sector") == "HDV") & F.col("technology").isNull()
    sector = F.when(F.col("technology").isin(*doubled), F.lit("HDV")).otherwise(F.col("ald_sector"))
    technology = F.when(unnamed_truck, F.lit(doubled["NA_HDV"])).otherwise(
        recode("technology", doubled, keep_other=True)
    )
    return (
        placed.withColumns({"ald_sector": sector, "technology": technology})
        .select(*schemas.SCENARIO_INPUT.fieldNames())
        .distinct()
    )
