"""Aggregate alignment score per company and sector."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import first_match, if_else, ratio, total, weighted_mean
from pathgauge.operators.lookup import fixed_lookup
from pathgauge.operators.ranking import average_rank_desc
from pathgauge.operators.reshape import strict_pivot
from pathgauge.params import Params
from pathgauge.plans.connect import GLOBAL, MARKET
from pathgauge.plans.names import sector_display_name

# All windows below contain these five columns, so rows placed by them once
# serve every one of them.
_PLACE = ["company_name", "id", "scenario", "scenario_geography", "ald_sector"]
_SERIES = ["company_name", "id", "scenario_source", "scenario", "scenario_geography", "ald_sector"]

RANK_COLUMNS = (
    "ald_sector",
    "company_name",
    "single_score_Case8",
    "rank",
    "aggregate_score_class",
    "aggregate_score_traffic_light",
)


def paired_years(connected: DataFrame, bridge: DataFrame, params: Params) -> DataFrame:
    """One row per technology series with its reference-year and end-year sums.

    Only two years count, so they become columns in the same aggregate that
    sums them; first and last values then need no ordered window. The columns of
    a year without rows are NULL, those of a year with rows never are.
    """
    scope = connected.where(
        F.col("year").isin(params.reference_year, params.end_year)
        & F.col("ald_sector").isin(*refdata.TECH_TYPES)
        & (F.col("equity_market") == MARKET)
    )
    listed = scope.join(bridge.withColumnRenamed("company_id", "id"), "id", "inner")

    def of_year(side: str, year: int) -> Column:
        known = F.coalesce(f"{side}_tech_prod", F.lit(0.0))
        return total(F.when(F.col("year") == year, known), params.exact_sums)

    return listed.groupBy(*_SERIES, "technology").agg(
        *[
            of_year(side, number).alias(f"{side}_{name}")
            for side in ("plan", "scen")
            for name, number in (("start", params.reference_year), ("end", params.end_year))
        ]
    )


def _has(year: str) -> Column:
    return F.col(f"plan_{year}").isNotNull()


def with_sector_totals(pairs: DataFrame, params: Params) -> DataFrame:
    """Sector totals per year. The source is not a key: equal scenario names pool."""
    window = Window.partitionBy(*_PLACE)
    return pairs.withColumns(
        {
            f"{side}_sec_{year}": total(f"{side}_{year}", params.exact_sums, window)
            for side in ("plan", "scen")
            for year in ("start", "end")
        }
    )


def _long(pairs: DataFrame, keys: list[str], per_year: dict[str, str], params: Params) -> DataFrame:
    """Two rows per series, one per year present; ``per_year`` maps a column to its stem."""

    def one(year: str, number: int) -> list[Column]:
        return [F.lit(number), *[F.col(stem.format(year=year)) for stem in per_year.values()]]

    both = F.stack(F.lit(2), *one("start", params.reference_year), *one("end", params.end_year))
    long = pairs.select(*keys, both.alias("year", *per_year))
    return long.where(F.col("plan_tech_prod").isNotNull())


def tech_share(connected: DataFrame, bridge: DataFrame, params: Params) -> DataFrame:
    """Technology sums, sector totals and shares for both years."""
    long = _long(
        with_sector_totals(paired_years(connected, bridge, params), params),
        [*_SERIES, "technology"],
        {
            "plan_tech_prod": "plan_{year}",
            "scen_tech_prod": "scen_{year}",
            "plan_sec_prod": "plan_sec_{year}",
            "scen_sec_prod": "scen_sec_{year}",
        },
        params,
    )
    return long.withColumn("plan_tech_share", ratio("plan_tech_prod", "plan_sec_prod")).withColumn(
        "scen_tech_share", ratio("scen_tech_prod", "scen_sec_prod")
    )


def with_factors(pairs: DataFrame, params: Params) -> DataFrame:
    """Weights and alignment of each typed technology; untyped ones drop out here.

    When only one of the two years is present it is both first and last.
    """
    plan_last = F.coalesce("plan_end", "plan_start")
    scen_last = F.coalesce("scen_end", "scen_start")
    scen_first = F.coalesce("scen_start", "scen_end")
    relevant = F.col("technology").isin(*params.most_relevant_techs)

    def larger_if_relevant(own: Column, other: Column) -> Column:
        return if_else(relevant & (own > other), own, other)

    def alignment(year: str) -> Column:
        plan, scen = F.col(f"plan_{year}"), F.col(f"scen_{year}")
        deviation = F.when(scen == 0, F.when(plan == 0, 0.0).otherwise(1.0)).otherwise(
            ratio(plan - scen, scen)  # NULL when the year has no rows
        )
        return F.when(F.col("type") == "Green", deviation).otherwise(-deviation)

    return (
        fixed_lookup(
            pairs, refdata.tech_types(pairs.sparkSession), ["technology", "ald_sector"], "inner"
        )
        .withColumn("production_change", F.abs(plan_last - scen_first))
        .withColumn(
            "scenario_change",
            larger_if_relevant(F.col("production_change"), F.abs(scen_last - scen_first)),
        )
        .withColumn("tech_allocation_weight", larger_if_relevant(plan_last, scen_last))
        .withColumn("weighting_factor", F.col("scenario_change") * F.col("tech_allocation_weight"))
        .withColumn("alignment_start", alignment("start"))
        .withColumn("alignment_end", alignment("end"))
    )


def scored_technologies(connected: DataFrame, bridge: DataFrame, params: Params) -> DataFrame:
    """Every scored technology, in both years, with the score of its company and year."""
    factors = with_factors(with_sector_totals(paired_years(connected, bridge, params), params), params)
    window = Window.partitionBy(*_SERIES)

    def score(year: str) -> Column:
        # A series without rows in this year has no part in the mean: weight 0.
        weight = F.when(_has(year), F.col("weighting_factor")).otherwise(0.0)
        return weighted_mean(f"alignment_{year}", weight, window, params.exact_sums)

    scored = factors.withColumns({"score_start": score("start"), "score_end": score("end")})
    long = _long(
        scored.where(F.col("scenario_geography") == GLOBAL),
        [
            *_SERIES,
            "technology",
            "type",
            "scenario_change",
            "production_change",
            "tech_allocation_weight",
            "weighting_factor",
        ],
        {
            "plan_tech_prod": "plan_{year}",
            "scen_tech_prod": "scen_{year}",
            "plan_sec_prod": "plan_sec_{year}",
            "scen_sec_prod": "scen_sec_{year}",
            "trajectory_alignment": "alignment_{year}",
            "single_score_Case8": "score_{year}",
        },
        params,
    )
    return long.withColumn("plan_tech_share", ratio("plan_tech_prod", "plan_sec_prod")).withColumn(
        "scen_tech_share", ratio("scen_tech_prod", "scen_sec_prod")
    )


def _picked(params: Params) -> Column:
    """Rows of the scenario picked for their sector, in a form the scan can prune by."""
    return reduce(
        or_,
        [
            (F.col("ald_sector") == sector)
            & (F.col("scenario_source") == pick.source)
            & (F.col("scenario") == pick.scenario)
            for sector, pick in params.score_picks.items()
        ],
    )


def company_scores(connected: DataFrame, bridge: DataFrame, params: Params) -> DataFrame:
    """End-year score of each company in the scenario picked for its sector.

    The pick uses keys of the score only, so it runs before the sums and reaches
    the scan. Sector totals play no part in the score and are not computed.
    """
    picked = connected.where((F.col("scenario_geography") == GLOBAL) & _picked(params))
    factors = with_factors(paired_years(picked, bridge, params), params)
    scores = (
        factors.where(_has("end"))
        .groupBy(*_SERIES)
        .agg(weighted_mean("alignment_end", "weighting_factor", exact=params.exact_sums).alias("single_score_Case8"))
        .select("ald_sector", "company_name", "single_score_Case8")
    )
    named = sector_display_name(
        scores,
        {
            "Power": refdata.SCORE_DISPLAY_NAMES,
            "Automotive": refdata.SCORE_DISPLAY_NAMES,
            "HDV": refdata.HDV_SCORE_DISPLAY_NAMES,
        },
    )
    for sector, pick in params.score_picks.items():
        if pick.only_companies:
            named = named.where(
                (F.col("ald_sector") != sector) | F.col("company_name").isin(*pick.only_companies)
            )
    return named.distinct()


def score_result(scores: DataFrame) -> DataFrame:
    """Rank within the sector, class and traffic light."""
    ranked = average_rank_desc(scores, "ald_sector", "single_score_Case8", "company_name")
    return score_classes(ranked).select(*RANK_COLUMNS)


def score_classes(scores: DataFrame) -> DataFrame:
    """Class and traffic light, which need no rank; reports read these alone."""
    good = F.coalesce(F.col("single_score_Case8") >= 0, F.lit(False))
    classes = first_match(
        [
            (F.col("ald_sector") == sector, F.when(good, F.lit(yes)).otherwise(F.lit(no)))
            for sector, (yes, no) in refdata.SCORE_CLASSES.items()
        ]
    )
    yes, no = refdata.SCORE_LIGHTS
    return (
        scores.withColumn("aggregate_score_class", classes)
        .withColumn("aggregate_score_traffic_light", F.when(good, F.lit(yes)).otherwise(F.lit(no)))
    )


_COMM_KEYS = ["technology", "ald_sector", "company_name", "scenario", "scenario_geography"]
_COMM_VALUES = (
    "plan_tech_share",
    "scen_tech_share",
    "scenario_change",
    "production_change",
    "tech_allocation_weight",
    "trajectory_alignment",
    "weighting_factor",
    "single_score_Case8",
)


def values_long(scored: DataFrame) -> DataFrame:
    """Plan and scenario values as rows, named by metric and year."""
    return scored.unpivot(
        [*_COMM_KEYS, "year"], ["plan_tech_prod", "scen_tech_prod"], "metric", "value"
    ).select(*_COMM_KEYS, F.concat_ws("_", "metric", "year").alias("metric"), "value")


def metric_names(params: Params) -> list[str]:
    return [
        f"{side}_tech_prod_{year}"
        for year in (params.reference_year, params.end_year)
        for side in ("plan", "scen")
    ]


def values_wide(scored: DataFrame, params: Params) -> DataFrame:
    """One row per technology with a column per metric and year."""
    return strict_pivot(values_long(scored), _COMM_KEYS, "metric", "value", metric_names(params))


def communication_plan(scored: DataFrame, params: Params) -> DataFrame:
    """End-year factors, with weights as shares of the company's sector, beside both years' values.

    Every end-year row also has values and a key holds one row per year, so the
    values and the right join onto them come out of a single aggregate.
    """
    end = F.col("year") == params.end_year
    sector = Window.partitionBy(*_COMM_KEYS[1:])
    of_sector = total(F.when(end, F.col("weighting_factor")), params.exact_sums, sector)
    weighted = scored.withColumn("weighting_factor", ratio("weighting_factor", of_sector))
    cells = []
    for year in (params.reference_year, params.end_year):
        here = F.col("year") == year
        cells.append(F.count_if(here).alias(f"_rows_{year}"))
        for side in ("plan", "scen"):
            name = f"{side}_tech_prod"
            cells.append(F.max(F.when(here, F.col(name))).alias(f"{name}_{year}"))
    cells += [F.max(F.when(end, F.col(c))).alias(c) for c in _COMM_VALUES]
    cells.append(F.max(F.when(end, F.col("type") == "Green")).alias("_green"))
    clash = (F.col(f"_rows_{params.reference_year}") > 1) | (F.col(f"_rows_{params.end_year}") > 1)
    message = F.lit("communication plan: more than one row per company, technology, scenario and year")
    return (
        weighted.groupBy(*_COMM_KEYS)
        .agg(*cells)
        .withColumn("type", F.when(F.col("_green"), F.lit("Green")).when(~F.col("_green"), F.lit("Brown")))
        .withColumn("type", F.when(clash, F.raise_error(message)).otherwise(F.col("type")))
        .select(*_COMM_KEYS, "type", *_COMM_VALUES, *metric_names(params))
    )
