"""One query per operator, each computed from whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathgauge import refdata, schemas
from pathgauge.functions.semantics import sum0, total, weighted_mean
from pathgauge.operators import interpolate_yearly, stack_named, unpivot_years
from pathgauge.operators.lookup import fixed_lookup
from pathgauge.plans import connect as conn
from pathgauge.plans import intensity as ei
from pathgauge.plans import production as prod
from pathgauge.plans import report, scenario, score, trajectory
from pathgauge.plans.names import display_name
from pathgauge.sources import tables, workbook
from pathgauge.sources.stages import stage_path, store
from pathgauge.workflow import technology_headings, technology_schema
from testbed import model
from testbed.model import PARAMS

Query = Callable[[SparkSession, str], DataFrame]

RATIO_DIGITS = 6


def rounded(df: DataFrame, columns: Sequence[str], digits: int = RATIO_DIGITS) -> DataFrame:
    """Round what is left of a division, for comparison with another engine."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared steps ---------------------------------------------------------------


def _production(spark, sf_dir) -> DataFrame:
    return model.production(model.shipped(spark, sf_dir))


def _assets(spark, sf_dir) -> DataFrame:
    """The production table, for results that sum it by company in the stage that makes it."""
    return model.production(model.shipped(spark, sf_dir, spread=True))


def _shipped(spark, sf_dir) -> DataFrame:
    """Shipments as a stage, so that the lines are read once however many tables need them."""
    return store(model.shipped(spark, sf_dir), "shipped")


def _wide(spark, sf_dir) -> DataFrame:
    """The production table as a stage, for results that read it more than once and need no scenarios."""
    return store(_production(spark, sf_dir), "production")


def _masterdata(wide: DataFrame, years=None) -> DataFrame:
    return prod.masterdata(wide, PARAMS.zero_emission_techs, years=years)


def _name_bridge(spark, sf_dir, wide: DataFrame) -> DataFrame:
    """Suppliers with shipments, by name and id, with their assessed sectors."""
    return conn.name_bridge(wide, model.companies(spark, sf_dir))


def _stored_bridge(spark, sf_dir, wide: DataFrame) -> DataFrame:
    """The bridge as a stage, as in a run; Spark then knows its size when it joins it."""
    return store(_name_bridge(spark, sf_dir, wide), "name_bridge")


def _scenario_input(shipped: DataFrame) -> DataFrame:
    """Both scenario tables come from the same totals."""
    totals = model.totals(shipped)
    return scenario.scenario_input(model.datasets(totals), model.pathway(totals), PARAMS)


def _scenario_raw(spark, sf_dir) -> DataFrame:
    totals = model.totals(model.shipped_gross(spark, sf_dir))
    return stack_named(model.datasets(totals), PARAMS.scenario_datasets)


def _scenario_long(spark, sf_dir, shipped: DataFrame) -> DataFrame:
    return scenario.scenario_long(
        _scenario_input(shipped), model.bridge(spark), model.regions(spark, sf_dir), PARAMS
    )


def _connected(
    spark,
    sf_dir,
    params=PARAMS,
    targets=lambda scenarios: scenarios,
    years=PARAMS.relevant_years,
    owned=lambda assets: assets,
) -> tuple[DataFrame, DataFrame]:
    """Connected table of all sources, and the name bridge, on top of the stored shipments."""
    shipped = _shipped(spark, sf_dir)
    wide = model.production(shipped)
    listed = _name_bridge(spark, sf_dir, wide)
    assets = prod.asset_sums(
        conn.in_scope(wide, listed, "company_id"),
        years=years,
        zero_techs=params.zero_emission_techs,
        exact=params.exact_sums,
    )
    connected = conn.connect(
        owned(prod.recode_hdv(assets)),
        targets(_scenario_long(spark, sf_dir, shipped)),
        model.regions(spark, sf_dir),
        conn.index_regions(wide),
        params,
        years=years,
    )
    return connected, listed


def _connected_stages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Connected table that scores and ratings need: assessed sources, first and last year."""
    connected, listed = _connected(spark, sf_dir, years=(PARAMS.reference_year, PARAMS.end_year))
    return conn.assessed(connected, PARAMS), listed


def _rated(sector: str) -> Query:
    def query(spark, sf_dir):
        connected, _ = _connected_stages(spark, sf_dir)
        rows = trajectory.rated(connected, PARAMS).where(F.col("ald_sector") == sector)
        scenarios = ("NPS", "SDS", "B2DS") if sector == "HDV" else ("STEPS", "APS", "NZE_2050")
        return rounded(
            rows.select(
                "id",
                "ald_sector",
                "technology",
                "category",
                "plan_tech_prod",
                *scenarios,
                "Scen_Rating",
                "traffic_light",
            ),
            scenarios,
        )

    return query


# --- queries ---------------------------------------------------------------------


def scan_wide(spark, sf_dir):
    return _production(spark, sf_dir)


def wide_years(spark, sf_dir):
    return unpivot_years(_production(spark, sf_dir), "ald_production")


def zero_emission(spark, sf_dir):
    return prod.zero_factor(unpivot_years(_production(spark, sf_dir), "ald_production"))


def prod_normalise(spark, sf_dir):
    return prod.normalise(_assets(spark, sf_dir))


def masterdata(spark, sf_dir):
    return _masterdata(_assets(spark, sf_dir))


def hdv_recode(spark, sf_dir):
    facts = prod.recode_hdv(_masterdata(_assets(spark, sf_dir)))
    return facts.groupBy("id", "ald_sector", "technology", "year").agg(
        sum0("ald_production").alias("ald_production")
    )


def hdv_pathway(spark, sf_dir):
    return scenario.hdv_pathway(model.pathway(model.totals(model.shipped_gross(spark, sf_dir))), PARAMS)


def scenario_union(spark, sf_dir):
    return _scenario_raw(spark, sf_dir)


def interpolate(spark, sf_dir):
    raw = _scenario_raw(spark, sf_dir)
    return rounded(interpolate_yearly(raw, scenario.SERIES_KEYS), ["value"])


def market_share(spark, sf_dir):
    return rounded(_scenario_input(model.shipped_gross(spark, sf_dir)), ["value", "tmsr", "smsp", "fair_share"])


def geo_bridge_join(spark, sf_dir):
    raw = _scenario_raw(spark, sf_dir)
    named = raw.withColumnRenamed("source", "scenario_source")
    return scenario.bridge_geography(named, model.bridge(spark))


def index_regions(spark, sf_dir):
    return conn.index_regions(_production(spark, sf_dir))


def scenario_long(spark, sf_dir):
    return rounded(_scenario_long(spark, sf_dir, model.shipped_gross(spark, sf_dir)), ["value", "tmsr", "smsp", "fair_share"])


def company_scope(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    return _masterdata(conn.in_scope(wide, _stored_bridge(spark, sf_dir, wide), "company_id"))


def scope_layout(spark, sf_dir):
    """The same rows from a stored table in order of the company id, by a filter that reaches its row groups."""
    wide = _wide(spark, sf_dir)
    ordered = prod.masterdata(wide, PARAMS.zero_emission_techs, ordered=True)
    stored, bridge = store(ordered, "masterdata", blooms=["id"]), _stored_bridge(spark, sf_dir, wide)
    return conn.in_scope(stored, bridge, ids=conn.listed_ids(bridge))


def name_bridge(spark, sf_dir):
    return _name_bridge(spark, sf_dir, _production(spark, sf_dir))


def bridge_join(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    facts = _masterdata(wide, years=[PARAMS.reference_year])
    return conn.with_company(facts, _stored_bridge(spark, sf_dir, wide))


def connect(spark, sf_dir):
    connected, _ = _connected(spark, sf_dir)
    return rounded(connected, ["scen_tech_prod"])


def connect_complete(spark, sf_dir):
    """Companies that own two thirds of the technologies, also with those they have no asset of."""
    some = (F.col("id") + F.length("technology")) % 3 != 0
    params = replace(PARAMS, complete_technologies=True)
    connected, _ = _connected(spark, sf_dir, params, owned=lambda assets: assets.where(some))
    return rounded(connected, ["scen_tech_prod"])


def exact_sums(spark, sf_dir):
    """Revenue per supplier and return flag, and its mean discount: sums whose last bits depend on the order of rows."""
    lines = spark.read.schema("l_suppkey bigint, l_extendedprice double, l_discount double, l_returnflag string").parquet(
        f"{sf_dir}/lineitem.parquet"
    )
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.groupBy("l_suppkey", "l_returnflag").agg(
        total(revenue, exact=True).alias("revenue"),
        weighted_mean("l_discount", revenue, exact=True).alias("mean_discount"),
    )


def _three_sources(scenarios: DataFrame) -> DataFrame:
    """The power targets under three names: every geography, Global alone, Global and one part."""
    geography = F.col("scenario_geography")
    versions = F.when(geography == "Global", F.array(F.lit("ALL"), F.lit("TOP"), F.lit("SOME")))
    versions = versions.when(geography == "OECD", F.array(F.lit("ALL"), F.lit("SOME"))).otherwise(F.array(F.lit("ALL")))
    own = scenarios.where((F.col("scenario_source") == "WEO2022") & (F.col("ald_sector") == "Power"))
    return own.withColumn("scenario_source", F.explode(versions))


def global_aggregate(spark, sf_dir):
    """Global as the sum of its parts where a source has them all, else as given."""
    params = replace(PARAMS, global_aggregate_sources=("ALL", "TOP", "SOME"), global_aggregate_sectors=("Power",))
    connected, _ = _connected(spark, sf_dir, params, _three_sources)
    return rounded(connected, ["scen_tech_prod"])


def per_source_output(spark, sf_dir):
    connected, _ = _connected(spark, sf_dir)
    stored = conn.store_per_source(connected)
    return stored.groupBy("scenario_source", "scenario").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("plan_tech_prod").alias("plan_tech_prod")
    )


def stage_roundtrip(spark, sf_dir):
    return store(_masterdata(_assets(spark, sf_dir)), "masterdata")


def csv_roundtrip(spark, sf_dir):
    path = stage_path(spark, "scenario_input.csv")
    tables.write_csv(_scenario_input(model.shipped_gross(spark, sf_dir)), path)
    back = tables.read_csv(spark, path, schemas.SCENARIO_INPUT)
    return rounded(back, ["value", "tmsr", "smsp", "fair_share"])


def production_csv(spark, sf_dir):
    path = stage_path(spark, "production.csv")
    tables.write_csv(_production(spark, sf_dir), path)
    return tables.read_production(spark, path)


def csv_rejects(spark, sf_dir):
    """Cells that are no numbers, out of the pass that reads the table."""
    wide, path = _production(spark, sf_dir), stage_path(spark, "spoiled.csv")
    spoiled = {
        f"_{y}": F.when(F.col(f"_{y}").isNotNull() & ((F.col("company_id") + y) % 7 == 0), F.lit(f"n/a {y}")).otherwise(
            F.col(f"_{y}").cast("string")
        )
        for y in model.YEARS
    }
    factor = F.col("emissions_factor")
    spoiled["emissions_factor"] = F.when(factor.isNotNull() & (F.col("company_id") % 5 == 0), F.lit("unknown")).otherwise(
        factor.cast("string")
    )
    tables.write_csv(wide.withColumns(spoiled), path)
    checked = store(tables.with_rejects(tables.read_text(spark, path)), "checked")
    return tables.rejects(checked)


def ei_benchmark(spark, sf_dir):
    """Production of the reference year against what the benchmark allows it to emit."""
    facts = _masterdata(_assets(spark, sf_dir), years=[PARAMS.reference_year])
    per_sector = facts.groupBy("ald_sector").agg(sum0("ald_production").alias("ald_production"))
    joined = fixed_lookup(per_sector, refdata.intensity_benchmarks(spark), ["ald_sector"], "inner")
    return rounded(joined.withColumn("allowed", F.col("ald_production") * F.col("value")), ["allowed"])


def tech_type_dim(spark, sf_dir):
    """Production per technology type and year."""
    facts = prod.recode_hdv(_masterdata(_assets(spark, sf_dir)))
    typed = fixed_lookup(facts, refdata.tech_types(spark), ["technology", "ald_sector"], "inner")
    return typed.groupBy("ald_sector", "type", "year").agg(sum0("ald_production").alias("ald_production"))


def ei_scope(spark, sf_dir):
    facts = _masterdata(_assets(spark, sf_dir), years=[PARAMS.reference_year])
    return ei.intensity_scope(facts, PARAMS)


def _intensity_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    wide = _wide(spark, sf_dir)
    listed = _stored_bridge(spark, sf_dir, wide)
    scoped = conn.in_scope(wide, listed, "company_id")
    return _masterdata(scoped, years=[PARAMS.reference_year]), listed


def ei_intensity(spark, sf_dir):
    return ei.company_intensity(*_intensity_inputs(spark, sf_dir), PARAMS)


def _intensity_result(spark, sf_dir) -> DataFrame:
    return ei.intensity_result(*_intensity_inputs(spark, sf_dir), PARAMS)


def ei_score(spark, sf_dir):
    return _intensity_result(spark, sf_dir)


def traj_base(spark, sf_dir):
    connected, _ = _connected_stages(spark, sf_dir)
    ladder = trajectory.scenario_ladder(connected, PARAMS)
    return rounded(ladder, refdata.RATED_SCENARIOS)


def display_names(spark, sf_dir):
    """Shipped quantity per company, with suppliers standing in for the listed companies."""
    names = [n for group in refdata.COMPANIES.values() for n in group]
    lines = model.read(spark, sf_dir, "lineitem")
    stand_in = F.array(*[F.lit(n) for n in names])[(F.col("l_suppkey") % len(names)).cast("int")]
    per_company = lines.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    shown = per_company.select(
        stand_in.alias("company_name"),
        stand_in.alias("score_name"),
        stand_in.alias("intensity_name"),
        "quantity",
    )
    shown = display_name(shown, refdata.SCORE_DISPLAY_NAMES, "score_name")
    shown = display_name(shown, refdata.INTENSITY_DISPLAY_NAMES, "intensity_name")
    return shown.groupBy("company_name", "score_name", "intensity_name").agg(
        F.sum("quantity").alias("quantity")
    )


def traj_wide(spark, sf_dir):
    connected, listed = _connected_stages(spark, sf_dir)
    result = trajectory.technology_result(connected, listed, PARAMS)
    return trajectory.sorted_result(result)


def tech_share(spark, sf_dir):
    result = score.tech_share(*_connected_stages(spark, sf_dir), PARAMS)
    return rounded(result, ["scen_tech_prod", "scen_sec_prod", "plan_tech_share", "scen_tech_share"])


def _scored(spark, sf_dir) -> DataFrame:
    return score.scored_technologies(*_connected_stages(spark, sf_dir), PARAMS)


def agg_factors(spark, sf_dir):
    rows = _scored(spark, sf_dir).select(
        "company_name",
        "id",
        "scenario_source",
        "scenario",
        "ald_sector",
        "technology",
        "year",
        "type",
        "scenario_change",
        "production_change",
        "tech_allocation_weight",
        "trajectory_alignment",
    )
    return rounded(
        rows, ["scenario_change", "production_change", "tech_allocation_weight", "trajectory_alignment"]
    )


def agg_score(spark, sf_dir):
    rows = _scored(spark, sf_dir).groupBy(
        "company_name", "id", "scenario_source", "scenario", "ald_sector", "year"
    ).agg(F.max("single_score_Case8").alias("single_score_Case8"), F.count(F.lit(1)).alias("n_technologies"))
    return rounded(rows, ["single_score_Case8"])


def _truck_maker(listed: DataFrame) -> DataFrame:
    """(company_id, company_name) of the first company assessed for cars and for trucks, or no row."""
    both = (
        listed.where(F.col("sector_assessed").isin("Automotive", "HDV"))
        .groupBy("company_id", "company_name")
        .agg(F.count_distinct("sector_assessed").alias("sectors"))
        .where("sectors = 2")
    )
    return both.agg(F.min(F.struct("company_id", "company_name")).alias("one")).where("one is not null").select("one.*")


def _as_truck_maker(df: DataFrame, maker: DataFrame, column: str) -> DataFrame:
    """That company goes by the name of one that the truck score shows, and the car sheet treats, in its own way."""
    one = maker.select(F.col("company_name").alias(column), F.lit("Volvo AB").alias("_name"))
    return fixed_lookup(df, one, [column], "left").withColumn(column, F.coalesce("_name", column)).select(*df.columns)


def truck_names(spark, sf_dir):
    """Scores under the names they show, which for a truck maker depends on the sector."""
    connected, listed = _connected_stages(spark, sf_dir)
    listed = store(listed, "name_bridge")
    named = _as_truck_maker(listed, _truck_maker(listed), "company_name")
    own = replace(PARAMS.score_picks["HDV"], only_companies=("Volvo", *model.HDV_SCORED))
    params = replace(PARAMS, score_picks={**PARAMS.score_picks, "HDV": own})
    return rounded(score.company_scores(connected, named, params), ["single_score_Case8"])


def placed_score(spark, sf_dir):
    """Scores from a connected table and a bridge that are placed by company id."""
    connected, listed = _connected_stages(spark, sf_dir)
    placed = conn.store_placed_per_source(connected, PARAMS.company_buckets)
    scores = score.company_scores(placed, conn.store_placed_bridge(listed, PARAMS.company_buckets), PARAMS)
    return rounded(scores.select("ald_sector", "company_name", "single_score_Case8"), ["single_score_Case8"])


def _score_result(spark, sf_dir) -> DataFrame:
    return score.score_result(score.company_scores(*_connected_stages(spark, sf_dir), PARAMS))


def agg_rank(spark, sf_dir):
    return rounded(_score_result(spark, sf_dir), ["single_score_Case8"])


def comm_values_long(spark, sf_dir):
    return rounded(score.values_long(_scored(spark, sf_dir)), ["value"])


def comm_values_wide(spark, sf_dir):
    wide = score.values_wide(_scored(spark, sf_dir), PARAMS)
    return rounded(wide, score.metric_names(PARAMS))


def comm_plan(spark, sf_dir):
    plan = score.communication_plan(_scored(spark, sf_dir), PARAMS)
    numbers = [c for c, kind in plan.dtypes if kind == "double"]
    return rounded(plan, numbers)


def _through_csv(spark, df: DataFrame, name: str, schema=None, headings=None) -> DataFrame:
    """A result file, written and read back."""
    path = stage_path(spark, f"{name}.csv")
    tables.write_csv(df, path, headings)
    return tables.read_csv(spark, path, schema, headings) if schema else tables.read_text(spark, path)


def result_csv(spark, sf_dir):
    """The ranked score of every sector, from one result file per sector."""
    result = store(_score_result(spark, sf_dir), "score", partition_by="ald_sector")
    own = schemas.SCORE_RESULT.fieldNames()
    files = [
        _through_csv(spark, result.where(F.col("ald_sector") == s).select(*own), s, schemas.SCORE_RESULT).withColumn(
            "ald_sector", F.lit(s)
        )
        for s in PARAMS.score_picks
    ]
    return rounded(reduce(DataFrame.unionByName, files), ["single_score_Case8"])


def _technology_report(sector: str, with_truck_maker: bool = False) -> Query:
    """A report sheet from the files of the earlier steps, written as a file itself."""

    def query(spark, sf_dir):
        connected, listed = _connected_stages(spark, sf_dir)
        connected = conn.store_per_source(connected.where(F.col("ald_sector") == sector))
        roster = model.roster(spark, sf_dir)
        if with_truck_maker:
            listed = store(listed, "name_bridge")
            maker = _truck_maker(listed)
            listed, roster = _as_truck_maker(listed, maker, "company_name"), _as_truck_maker(roster, maker, "Company")
        classes = score.score_classes(score.company_scores(connected, listed, PARAMS))
        fields = [f for f in schemas.SCORE_RESULT.fields if f.name in classes.columns]
        scores = _through_csv(
            spark,
            classes.where(F.col("ald_sector") == sector).select(*[f.name for f in fields]),
            "score",
            T.StructType(fields),
        ).withColumn("ald_sector", F.lit(sector))
        technologies = _through_csv(
            spark,
            trajectory.technology_result(connected, listed, PARAMS),
            "technologies",
            technology_schema(),
            technology_headings(),
        )
        roster = _through_csv(spark, roster, "roster")
        sheet = report.technology_report(roster, scores, technologies, sector)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in sheet.columns])
        return _through_csv(spark, sheet, "report", schema, report.headings(sector))

    return query


def report_intensity(spark, sf_dir):
    """The three intensity sheets, appended with their sector."""
    result = store(_intensity_result(spark, sf_dir), "intensity")
    companies = model.roster(spark, sf_dir)
    sheets = [
        report.intensity_report(companies, result, sector).withColumn("sheet", F.lit(sector))
        for sector in ("Cement", "Steel", "Aviation")
    ]
    return sheets[0].unionByName(sheets[1]).unionByName(sheets[2])


_START_ROWS = {sheet: skip + 1 for sheet, skip in refdata.TEMPLATE_SKIP.items()}


def _template(spark, sf_dir) -> str:
    """A report template: companies under the headings of each sheet, below rows of notes."""
    notes, path = stage_path(spark, "notes.xlsx"), stage_path(spark, "template.xlsx")
    lines = model.read(spark, sf_dir, "region").select(F.concat(F.lit("Region: "), "r_name").alias("Notes"))
    workbook.write_sheets({sheet: lines for sheet in (*_START_ROWS, "Cover")}, notes)
    companies = model.roster(spark, sf_dir)
    listed = {s: companies.where(F.col("sheet") == s).select("Company", F.lit(None).cast("string").alias("1. traffic light")) for s in _START_ROWS}
    workbook.write_sheets(listed, path, start_rows=_START_ROWS, template=notes)
    return path


def roster_skip(spark, sf_dir):
    """Companies of every sheet of a template, below the rows to skip."""
    path = _template(spark, sf_dir)
    return workbook.read_sheets(spark, path, refdata.TEMPLATE_SKIP, "sheet string, Company string")


def report_book(spark, sf_dir):
    """The three intensity sheets placed into a template by one job, and read back from the workbook."""
    template, path = _template(spark, sf_dir), stage_path(spark, "report.xlsx")
    result = store(_intensity_result(spark, sf_dir), "intensity")
    sectors = ("Cement", "Steel", "Aviation")
    skip = {s: refdata.TEMPLATE_SKIP[s] for s in sectors}
    cells, columns = workbook.read_sheets(spark, template, skip), workbook.sheet_headings(template, skip)
    sheets = {
        s: report.filled(report.intensity_report(report.template_roster(cells, s, columns[s]), result, s), s, columns[s])
        for s in sectors
    }
    workbook.write_sheets(sheets, path, start_rows=_START_ROWS, template=template, order="row")
    names = report.headings("Steel")
    own = ", ".join(f"`{names[c]}` string" for c in ("overall_light", "overall_value"))
    back = workbook.read_sheets(spark, path, skip, f"Company string, {own}, sheet string")
    return back.toDF("Company", "overall_light", "overall_value", "sheet")


QUERIES: dict[str, Query] = {
    "scan_wide": scan_wide,
    "production_csv": production_csv,
    "csv_rejects": csv_rejects,
    "unpivot_years": wide_years,
    "zero_emission": zero_emission,
    "prod_normalise": prod_normalise,
    "masterdata": masterdata,
    "hdv_recode": hdv_recode,
    "hdv_pathway": hdv_pathway,
    "scenario_union": scenario_union,
    "interpolate": interpolate,
    "market_share": market_share,
    "geo_bridge_join": geo_bridge_join,
    "index_regions": index_regions,
    "scenario_long": scenario_long,
    "company_scope": company_scope,
    "scope_layout": scope_layout,
    "name_bridge": name_bridge,
    "bridge_join": bridge_join,
    "connect": connect,
    "connect_complete": connect_complete,
    "global_aggregate": global_aggregate,
    "per_source_output": per_source_output,
    "stage_roundtrip": stage_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "ei_benchmark": ei_benchmark,
    "tech_type_dim": tech_type_dim,
    "ei_scope": ei_scope,
    "ei_intensity": ei_intensity,
    "ei_score": ei_score,
    "traj_base": traj_base,
    "traj_power": _rated("Power"),
    "traj_auto": _rated("Automotive"),
    "traj_hdv": _rated("HDV"),
    "traj_wide": traj_wide,
    "display_names": display_names,
    "exact_sums": exact_sums,
    "tech_share": tech_share,
    "agg_factors": agg_factors,
    "agg_score": agg_score,
    "placed_score": placed_score,
    "truck_names": truck_names,
    "agg_rank": agg_rank,
    "comm_values_long": comm_values_long,
    "comm_values_wide": comm_values_wide,
    "comm_plan": comm_plan,
    "result_csv": result_csv,
    "report_power": _technology_report("Power"),
    "report_auto": _technology_report("Automotive"),
    "report_left_out": _technology_report("Automotive", with_truck_maker=True),
    "report_intensity": report_intensity,
    "roster_skip": roster_skip,
    "report_book": report_book,
}
