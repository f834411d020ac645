"""Company scope, and production connected to scenario targets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathgauge.functions.semantics import floor_at_zero, total
from pathgauge.operators.lookup import fixed_lookup, salted_join
from pathgauge.params import Params
from pathgauge.plans.production import sum_years, year_rows
from pathgauge.sources.layout import store_placed
from pathgauge.sources.stages import store

MARKET = "GlobalMarket"
GLOBAL = "Global"

CONNECTED_COLUMNS = (
    "id",
    "equity_market",
    "scenario_source",
    "scenario",
    "scenario_geography",
    "ald_sector",
    "technology",
    "year",
    "plan_tech_prod",
    "scen_tech_prod",
)


def name_bridge(wide: DataFrame, companies: DataFrame) -> DataFrame:
    """Listed companies with the ids they report under and the sectors they are assessed in.

    Names and ids are made distinct before the join, so what is shuffled is one
    row per company however many assets it has.
    """
    pairs = wide.select("company_name", "company_id").distinct()
    listed = companies.select("company_name", "sector_assessed").distinct()
    return pairs.join(listed, "company_name", "inner")


#: Ids up to this many are put into the filter of a scan; a longer list is joined.
MOST_PUSHED = 2_000


def listed_ids(bridge: DataFrame, most: int = MOST_PUSHED) -> list[int] | None:
    """Ids of the listed companies, None if there are more than ``most``; reads a stored bridge."""
    ids = bridge.where(F.col("company_id").isNotNull()).select("company_id").distinct().limit(most + 1).collect()
    return None if len(ids) > most else sorted(r[0] for r in ids)


def in_scope(
    facts: DataFrame, bridge: DataFrame, id: str = "id", *, ids: Sequence[int] | None = None
) -> DataFrame:
    """Rows of listed companies; to be applied ahead of the first sum.

    With ``ids``, those of the whole bridge (``listed_ids``), it is a filter that
    reaches the files, where a table laid out by id lets the scan pass over most.
    """
    if ids is not None:
        return facts.where(F.col(id).isin(*ids) if ids else F.lit(False))
    return facts.join(bridge.select(F.col("company_id").alias(id)), id, "left_semi")


def with_company(facts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Attach name and assessed sector; a company listed under two sectors doubles its rows."""
    return facts.join(bridge.withColumnRenamed("company_id", "id"), "id", "left")


def index_regions(wide: DataFrame) -> DataFrame:
    """One market that holds every country an asset stands in."""
    return wide.select(F.col("asset_country").alias("country_iso")).distinct().withColumn(
        "equity_market", F.lit(MARKET)
    )


def company_plans(
    assets: DataFrame,
    regions: DataFrame,
    markets: DataFrame,
    params: Params,
    years: Iterable[int] | None = None,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Production plan per company, market, geography, technology and year.

    ``_tech0`` and ``_sector0`` are the reference-year plans of the technology
    and of its whole sector. With ``targets`` a company also gets the technologies
    these name for its sector, with a plan of 0 in every year. ``assets`` holds the years side by side, see
    ``production.asset_sums``, and the listed companies only, see ``in_scope``.

    Assets are summed by country first, and combined before they are shuffled: a
    company holding a large part of all assets arrives as one row per country
    and technology. Those few rows are then placed by company id, and everything
    keyed by company, up to the scores, uses that placement without another
    shuffle.
    """
    years = sorted({params.reference_year, *(years or params.relevant_years)})
    by_country = sum_years(
        assets.where(
            F.col("ald_sector").isin(*params.all_sectors)
            & ~F.coalesce(F.col("technology").isin(*params.excluded_techs), F.lit(False))
        ),
        ["id", "ald_location", "ald_sector", "technology"],
        years,
        params.exact_sums,
    ).repartition("id")
    places = (
        regions.where(F.col("scenario_geography").isin(*params.scenario_geographies))
        .join(markets, F.col("country") == F.col("country_iso"))
        .select(F.col("country").alias("ald_location"), "scenario_geography", "equity_market")
        .distinct()
    )
    sector = ["id", "equity_market", "scenario_geography", "ald_sector"]
    # At most one row per country, listed geography and market.
    placed = fixed_lookup(by_country, places, ["ald_location"], "inner")
    plans = sum_years(placed, [*sector, "technology"], years, params.exact_sums)
    if targets is not None:
        plans = complete(plans, sector, sector_technologies(targets, params), years)
    with_start = plans.withColumn(
        "_tech0", F.coalesce(f"v_{params.reference_year}", F.lit(0.0))
    ).withColumn("_sector0", total("_tech0", params.exact_sums, Window.partitionBy(*sector)))
    return year_rows(with_start, [*sector, "technology", "_tech0", "_sector0"], years, "plan_tech_prod")


def sector_technologies(targets: DataFrame, params: Params) -> DataFrame:
    """(ald_sector, _listed): the technologies that targets name, one row per sector of the model."""
    named = targets.where(
        F.col("ald_sector").isin(*params.all_sectors)
        & F.col("technology").isNotNull()
        & ~F.col("technology").isin(*params.excluded_techs)
    )
    return named.groupBy("ald_sector").agg(F.collect_set("technology").alias("_listed"))


def complete(plans: DataFrame, sector: Sequence[str], listed: DataFrame, years: Iterable[int]) -> DataFrame:
    """``plans`` with a row of zeros for each listed technology that a company's sector lacks.

    A company's technologies of a sector, a few dozen at most, are gathered where
    they lie, as ``plans`` is placed by company; a generator then yields them and
    what the list has beyond them. The list is looked up, one row per sector, so
    no join makes more rows than it reads.
    """
    columns = ["technology", *[f"v_{y}" for y in years]]
    gathered = plans.groupBy(*sector).agg(F.collect_list(F.struct(*columns)).alias("_own"))
    lacking = F.array_except(F.coalesce("_listed", F.array().cast("array<string>")), F.col("_own.technology"))
    zero = lambda t: F.struct(t.alias("technology"), *[F.lit(0.0).alias(c) for c in columns[1:]])
    return fixed_lookup(gathered, listed, ["ald_sector"], "left").select(
        *sector, F.inline(F.concat("_own", F.transform(lacking, zero)))
    )


def connect(
    assets: DataFrame,
    scenarios: DataFrame,
    regions: DataFrame,
    markets: DataFrame,
    params: Params,
    *,
    years: Iterable[int] | None = None,
    salts: int = 0,
) -> DataFrame:
    """Each listed company's plan beside the production the scenario expects of it.

    The expected production starts at the company's own plan in the reference
    year and moves by the scenario's share of the company's sector (technologies
    to build out) or of the technology itself (all others); it is never negative.
    A technology that a company has no asset of has no plan and hence no row,
    also where its sector should build it out, unless the parameters ask to
    complete them: then it has a plan of 0, and the sector's share is expected.

    ``years`` narrows the result, as scores and ratings need the first and the
    last year only; the reference year is always kept.
    ``assets`` are those of listed companies (``in_scope``). ``scenarios`` holds
    a row per source, scenario, geography, technology and year, so how it is
    joined is left to its size; ``salts`` above 0 asks for a salted shuffle join.
    """
    targets = global_from_parts(scenarios, params)
    named = scenarios if params.complete_technologies else None
    plans = company_plans(assets, regions, markets, params, years, named)
    keys = ["ald_sector", "technology", "scenario_geography", "year"]
    if salts:
        joined = salted_join(plans, targets, keys, "inner", spread_by=["id"], salts=salts)
    else:
        joined = plans.join(targets, keys, "inner")
    base = F.when(F.col("technology").isin(*params.green_techs), F.col("_sector0")).otherwise(F.col("_tech0"))
    expected = floor_at_zero(F.col("_tech0") + F.col("fair_share") * base)
    connected = joined.withColumn("scen_tech_prod", expected)
    if not _aggregates_global(params):
        return connected.select(*CONNECTED_COLUMNS)
    places = F.when(F.col("_in_global"), F.array("scenario_geography", F.lit(GLOBAL))).otherwise(
        F.array("scenario_geography")
    )
    keys = [c for c in CONNECTED_COLUMNS if c not in ("plan_tech_prod", "scen_tech_prod")]
    return (
        connected.withColumn("scenario_geography", F.explode(places))
        .groupBy(*keys)
        .agg(*[total(c, params.exact_sums).alias(c) for c in ("plan_tech_prod", "scen_tech_prod")])
    )


def _aggregates_global(params: Params) -> bool:
    return bool(params.global_aggregate_sources and params.global_aggregate_sectors)


def global_from_parts(scenarios: DataFrame, params: Params) -> DataFrame:
    """Targets; for the listed sources and sectors Global becomes the sum of the other geographies.

    That needs all of the listed geographies: where a source, scenario,
    technology and year has each of them, the given Global target leaves and the
    others are marked ``_in_global``, which adds what they come to with each
    company's plans to its Global row. Where one is missing the targets stay as
    they are given, so a source that knows Global alone keeps it. This works on
    the targets, which are few, and costs no pass over the plans.
    """
    targets = scenarios.select(
        "scenario_source", "scenario", "ald_sector", "technology", "scenario_geography", "year", "fair_share"
    )
    if not _aggregates_global(params):
        return targets
    parts = [g for g in params.scenario_geographies if g != GLOBAL]
    listed = F.coalesce(
        F.col("scenario_source").isin(*params.global_aggregate_sources)
        & F.col("ald_sector").isin(*params.global_aggregate_sectors),
        F.lit(False),
    )
    series = Window.partitionBy("scenario_source", "scenario", "ald_sector", "technology", "year")
    is_part = F.col("scenario_geography").isin(*parts)
    present = F.size(F.collect_set(F.when(is_part, F.col("scenario_geography"))).over(series))
    whole = listed & (present == len(parts)) & F.lit(bool(parts))
    return (
        targets.withColumn("_whole", whole)
        .where(~(F.col("_whole") & (F.col("scenario_geography") == GLOBAL)))
        .withColumn("_in_global", F.col("_whole") & is_part)
        .drop("_whole")
    )


def store_per_source(connected: DataFrame, path: str | None = None, keep_other: bool = False) -> DataFrame:
    """Write one folder per scenario source in a single job and read it back.

    With ``keep_other`` the folders of sources that aren't in ``connected`` stay
    as they are, files included.

    Rows are dealt by source into tasks of even size: a source holding most rows
    is written by many tasks, a small one by one, so there are few small files. A
    later filter on the source reads only its folder.
    """
    dealt = connected.hint("rebalance", "scenario_source")
    stored = store(dealt, "connected", partition_by="scenario_source", path=path, keep_other=keep_other)
    return stored.select(*CONNECTED_COLUMNS)


def store_placed_per_source(
    connected: DataFrame, buckets: int, path: str | None = None, keep_other: bool = False
) -> DataFrame:
    """One folder per scenario source as in ``store_per_source``, bucketed by company id within each.

    A name bridge placed likewise (``store_placed_bridge``) is joined to it, and
    sums and sector totals by company are made, without another shuffle.
    """
    stored = store_placed(
        connected, "connected", by="id", buckets=buckets, partition_by="scenario_source", path=path, keep_other=keep_other
    )
    return stored.select(*CONNECTED_COLUMNS)


def store_placed_bridge(bridge: DataFrame, buckets: int, path: str | None = None) -> DataFrame:
    return store_placed(bridge, "name_bridge", by="company_id", buckets=buckets, path=path)


def assessed(connected: DataFrame, params: Params) -> DataFrame:
    """Rows of the sources that scores and ratings read; prunes the folders of a stored table.

    Other sources may carry a scenario of the same name and would count twice.
    """
    return connected.where(F.col("scenario_source").isin(*params.assessed_sources))
