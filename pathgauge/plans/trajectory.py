"""Rating and traffic light per technology, from the plan's place among the scenarios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import first_match
from pathgauge.operators.reshape import strict_pivot
from pathgauge.params import Params
from pathgauge.plans.connect import GLOBAL, MARKET
from pathgauge.plans.names import display_name

_CODE = {rating: code for code, (rating, _) in enumerate(refdata.RATINGS)}
_NO_RATING = 0
_NOT_APPLICABLE = _CODE[refdata.NOT_APPLICABLE]
_NZE, _APS, _ABOVE_APS, _STEPS = (
    _CODE["Aligned with/Below NZE (<1.5°C)"],
    _CODE["Aligned with APS (1.5°C - 1.7°C)"],
    _CODE["Above APS (>1.7°C)"],
    _CODE["Aligned with /Above STEPS (>2.5°C)"],
)
_HDV_B2DS, _HDV_SDS, _HDV_NPS, _HDV_WORST = (
    _CODE["Aligned to B2DS <1.75°C"],
    _CODE["Close to 2DS 1.75C-2°C"],
    _CODE["Above 2DS >2°C"],
    _CODE["Significantly above 2DS >2.7°C"],
)


@dataclass(frozen=True)
class Ladder:
    """Ratings of one sector and category: conditions tried in order, and what is left.

    Each condition compares the plan with scenario values. A condition on an
    unknown value doesn't hold. Where all are strict, a plan that equals a
    scenario value falls through to ``fallback``.
    """

    arms: tuple[tuple[str, int], ...]
    fallback: int

    def rating(self) -> Column:
        return first_match([(F.expr(when), F.lit(code)) for when, code in self.arms], F.lit(self.fallback))


# The ladder of each sector and technology category.
LADDERS: dict[tuple[str, str], Ladder] = {
    ("Power", "Green"): Ladder(
        (
            ("plan = 0", _NOT_APPLICABLE),
            ("plan >= STEPS and plan < APS", _ABOVE_APS),
            ("plan >= APS and plan < NZE_2050", _APS),
            ("plan >= NZE_2050", _NZE),
        ),
        fallback=_STEPS,
    ),
    ("Power", "Brown"): Ladder(
        (
            ("plan > STEPS", _STEPS),
            ("plan > APS and plan < STEPS", _ABOVE_APS),
            ("plan > NZE_2050 and plan < APS", _APS),
            ("plan = 0 and NZE_2050 = 0", _NOT_APPLICABLE),
        ),
        fallback=_NZE,
    ),
    ("Automotive", "Green"): Ladder(
        (("plan = 0", _NOT_APPLICABLE), ("plan >= NZE_2050", _NZE), ("plan >= APS", _APS)),
        fallback=_ABOVE_APS,
    ),
    ("Automotive", "Brown"): Ladder(
        (("plan = 0", _NOT_APPLICABLE), ("plan <= NZE_2050", _NZE), ("plan <= APS", _APS)),
        fallback=_ABOVE_APS,
    ),
    ("HDV", "Green"): Ladder(
        (
            ("plan = 0", _NOT_APPLICABLE),
            ("plan < NPS", _HDV_WORST),
            ("plan >= NPS and plan < SDS", _HDV_NPS),
            ("plan >= SDS and plan < B2DS", _HDV_SDS),
            ("plan >= B2DS", _HDV_B2DS),
        ),
        fallback=_NO_RATING,
    ),
    ("HDV", "Brown"): Ladder(
        (
            ("plan >= NPS", _HDV_WORST),
            ("plan >= SDS and plan < NPS", _HDV_NPS),
            ("plan >= B2DS and plan < SDS", _HDV_SDS),
            ("plan < B2DS", _HDV_B2DS),
            ("plan = 0", _NOT_APPLICABLE),
        ),
        fallback=_NO_RATING,
    ),
}


def scenario_ladder(connected: DataFrame, params: Params) -> DataFrame:
    """End-year plan of each company and technology beside all scenario values.

    All three sectors go through one aggregate. The plan is part of the key; two
    rows for one scenario are an error.
    """
    scope = connected.where(
        (F.col("year") == params.end_year)
        & (F.col("scenario_geography") == GLOBAL)
        & (F.col("equity_market") == MARKET)
        & F.col("ald_sector").isin(*refdata.RATED_TECHS)
    )
    wide = strict_pivot(
        scope.withColumnRenamed("plan_tech_prod", "plan"),
        ["id", "ald_sector", "technology", "plan"],
        "scenario",
        "scen_tech_prod",
        refdata.RATED_SCENARIOS,
    )
    brown = F.coalesce(F.col("technology").isin(*params.brown_techs), F.lit(False))
    return wide.withColumn("category", F.when(brown, F.lit("Brown")).otherwise(F.lit("Green")))


def _stricter_power_target() -> Column:
    """Power: the strictest target is never less ambitious than the announced pledges."""
    weaker = F.when(F.col("category") == "Green", F.col("NZE_2050") <= F.col("APS")).otherwise(
        F.col("NZE_2050") >= F.col("APS")
    )
    return F.when((F.col("ald_sector") == "Power") & weaker, F.col("APS")).otherwise(F.col("NZE_2050"))


def rate(ladder: DataFrame) -> DataFrame:
    """Rating code of every row; see ``refdata.RATINGS``."""
    code = F.lit(None).cast("int")
    for (sector, category), ladder_of in LADDERS.items():
        here = (F.col("ald_sector") == sector) & (F.col("category") == category)
        code = F.when(here, ladder_of.rating()).otherwise(code)
    return ladder.withColumn("NZE_2050", _stricter_power_target()).withColumn("rating_code", code)


def rating_text(code: Column) -> Column:
    return F.array(*[F.lit(text) for text, _ in refdata.RATINGS])[code]


def rating_light(code: Column) -> Column:
    return F.array(*[F.lit(light).cast("string") for _, light in refdata.RATINGS])[code]


def rated(connected: DataFrame, params: Params) -> DataFrame:
    """Ratings in words, one row per company id and technology."""
    coded = rate(scenario_ladder(connected, params))
    return (
        coded.withColumn("Scen_Rating", rating_text(F.col("rating_code")))
        .withColumn("traffic_light", rating_light(F.col("rating_code")))
        .withColumnRenamed("plan", "plan_tech_prod")
    )


def rated_columns(sector: str, techs: Mapping[str, Sequence[str]] = refdata.RATED_TECHS) -> dict[str, str]:
    return {refdata.tech_key(sector, tech): tech for tech in techs[sector]}


def run_techs(targets: DataFrame) -> dict[str, tuple[str, ...]]:
    """Technologies to rate per sector: the fixed list, then what else the run's targets name.

    Reads the distinct technologies of the stored targets, a few dozen.
    """
    named = targets.where(F.col("ald_sector").isin(*refdata.RATED_TECHS)).select("ald_sector", "technology")
    found = {(r.ald_sector, r.technology) for r in named.distinct().collect() if r.technology is not None}
    return {
        sector: (*fixed, *sorted(t for s, t in found if s == sector and t not in fixed))
        for sector, fixed in refdata.RATED_TECHS.items()
    }


def technology_result(
    connected: DataFrame,
    bridge: DataFrame,
    params: Params,
    techs: Mapping[str, Sequence[str]] = refdata.RATED_TECHS,
) -> DataFrame:
    """One row per company in the sector it is assessed in, two columns per technology.

    ``techs`` widens the result by technologies that a run has beside the fixed
    ones; one that is in neither is an error. Only the rating code is pivoted;
    text and light are looked up afterwards, which keeps the aggregate on plain
    numbers.
    """
    coded = rate(scenario_ladder(connected, params))
    assessed = bridge.select(
        F.col("company_id").alias("id"), "company_name", F.col("sector_assessed").alias("ald_sector")
    )
    keys = {key: tech for sector in techs for key, tech in rated_columns(sector, techs).items()}
    wide = strict_pivot(
        coded.join(assessed, ["id", "ald_sector"], "inner"),
        ["company_name", "ald_sector"],
        "technology",
        "rating_code",
        list(keys.values()),
        columns=list(keys),
        distinct_rows=True,
        reject_other=True,
    )
    result = wide.select(
        "company_name",
        "ald_sector",
        *[rating_text(F.col(key)).alias(f"Rating_{key}") for key in keys],
        *[rating_light(F.col(key)).alias(f"traffic_light_{key}") for key in keys],
    )
    return display_name(result, refdata.SCORE_DISPLAY_NAMES)


def sorted_result(result: DataFrame) -> DataFrame:
    """Order of the result file; missing names last."""
    return result.orderBy(F.asc_nulls_last("company_name"), F.asc_nulls_last("ald_sector"))
