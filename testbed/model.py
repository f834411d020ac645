"""The model's input tables, derived by Spark from the order tables of the test data.

Every table is computed from all rows of its source. Companies are suppliers,
assets are the parts they ship, production is what they ship in a year net of
returns. Weights and factors are sums of powers of two, so that sums come out
the same in whichever order an engine adds them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathgauge.functions.semantics import first_match
from pathgauge.operators.lookup import fixed_lookup
from pathgauge.params import Params, ScorePick, profile

YEARS = range(1995, 2002)
KNOTS = (1995, 1998, 2001)

# The truck score is made for some of the companies only.
HDV_SCORED = tuple(f"Supplier#{n:09d}" for n in range(1, 200, 2))

PARAMS: Params = profile(
    "2023Q2",
    reference_year=1996,
    time_horizon=5,
    scenario_datasets=("weo_2022", "sector_2021", "geco_2021"),
    # GECO2021 has a scenario of the same name as WEO2022; scores and ratings leave it out.
    scenario_sources=("WEO2022", "ETP2017", "GECO2021"),
    brown_techs=("ICE", "CoalCap", "GasCap", "OilCap", "ICE_HDV"),
    score_picks={
        "Power": ScorePick("WEO2022", "NZE_2050"),
        "Automotive": ScorePick("WEO2022", "NZE_2050"),
        "HDV": ScorePick("ETP2017", "B2DS", HDV_SCORED),
    },
)

# Sectors in the order a supplier's nation number points into.
ASSESSED = ("Power", "Automotive", "HDV", "Steel", "Cement", "Aviation")
TWO_SECTOR_BALANCE = 9000

UNITS = {
    "Power": "MW",
    "Automotive": "# vehicles",
    "HDV": "# trucks",
    "Steel": "t steel",
    "Coal": "t coal",
    "Oil&Gas": "GJ",
    "Cement": "t cement",
    "Aviation": "pkm",
}
FACTOR_SCALE = {"Steel": 16.0, "Cement": 64.0, "Aviation": 524288.0}
UNKNOWN_FACTOR_SIZE = 50

POWER = ("CoalCap", "GasCap", "HydroCap", "NuclearCap", "OilCap", "RenewablesCap")
AUTOMOTIVE = ("Electric", "Hybrid", "ICE", "FuelCell")
HDV = ("Electric_HDV", "Hybrid No-Plug_HDV", "ICE Diesel_HDV", "ICE CNG_HDV", "FuelCell_HDV")
STEEL = ("Electric Arc Furnace", "Open Hearth", "Open HearthGrade")
COAL = ("ThermalGrade", "Metallurgical")
OIL_GAS = ("Oil and Condensate", "Gas")
CEMENT = ("Integrated facility", "Grinding")
AVIATION = ("Passenger", "Freight")

PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
BRANDS = range(1, 26)

GROWING = ("Electric", "Hybrid", "FuelCell", "HydroCap", "NuclearCap", "RenewablesCap")
AMBITION = {
    # scenario -> (growing 1998, growing 2001, shrinking 1998, shrinking 2001)
    "STEPS": (1.125, 1.25, 0.9375, 0.875),
    "APS": (1.25, 1.5, 0.75, 0.625),
    "NZE_2050": (1.5, 2.0, 0.625, 0.375),
}
PATHWAY_STEP = {"rts": 1 / 64, "sds": 1 / 32, "b2ds": 1 / 16}
PATHWAY_KIND = {
    "Electric_HDV": "electric",
    "Hybrid No-Plug_HDV": "hybrid",
    "ICE Diesel_HDV": "ice",
    "ICE CNG_HDV": "ice",
    "FuelCell_HDV": "other",
}
# GECO2021 gives car technologies as those of trucks, under the names that need mending.
GECO_TRUCKS = {
    "Electric": "Electric_HDV_HDV",
    "Hybrid": "Hybrid_HDV_HDV",
    "ICE": "ICE_HDV_HDV",
    "FuelCell": "NA_HDV",
}
RICH_REGIONS = ("AMERICA", "EUROPE")

BRIDGE = (
    ("WEO2022", "World", "Global"),
    ("WEO2022", "Advanced economies", "OECD"),
    ("WEO2022", "Emerging economies", "NonOECD"),
    ("ETP2017", "Global", "Global"),
    ("SECTOR2021", "World", "Global"),
    ("GECO2021", "World", "Global"),
)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int",
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with the columns the model uses; a given schema saves the footer pass."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[number % len(values)]


def _kind(p_type: str, n: int) -> tuple[str, str, str, float]:
    """Sector, technology, unit and factor scale of a part type and brand number."""
    if p_type == "PROMO":
        sector, techs = ("Steel", STEEL) if n <= 13 else ("Coal", COAL) if n <= 19 else ("Oil&Gas", OIL_GAS)
    else:
        sector, techs = {
            "ECONOMY": ("Power", POWER),
            "LARGE": ("Automotive", AUTOMOTIVE),
            "MEDIUM": ("HDV", HDV),
            "SMALL": ("Cement", CEMENT),
            "STANDARD": ("Aviation", AVIATION),
        }[p_type]
    return sector, techs[n % len(techs)], UNITS[sector], FACTOR_SCALE.get(sector, 64.0)


def _kinds() -> tuple[list[tuple], list[tuple]]:
    """The rule as two tables: part type and brand to a kind number, and the kinds.

    The rule knows 6 part types and 25 brands, so neither exceeds 150 rows.
    """
    of_part = {(t, f"Brand#{n}"): _kind(t, n) for t in PART_TYPES for n in BRANDS}
    number = {kind: i for i, kind in enumerate(dict.fromkeys(of_part.values()))}
    return [(*part, number[kind]) for part, kind in of_part.items()], [(i, *kind) for kind, i in number.items()]


def part_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind number and size of every part."""
    rule = spark.createDataFrame(_kinds()[0], "p_type string, p_brand string, kind int")
    unknown = F.raise_error(F.concat_ws(" ", F.lit("no kind for part type and brand"), "p_type", "p_brand"))
    return fixed_lookup(read(spark, sf_dir, "part"), rule, ["p_type", "p_brand"], "left").select(
        F.col("p_partkey").alias("l_partkey"), F.coalesce("kind", unknown.cast("int")).alias("kind"), "p_size"
    )


def with_kind(df: DataFrame) -> DataFrame:
    """Kind number and size to sector, technology, unit and emission factor."""
    kinds = df.sparkSession.createDataFrame(
        _kinds()[1], "kind int, sector string, technology string, unit string, scale double"
    )
    factor = F.when(F.col("p_size") != UNKNOWN_FACTOR_SIZE, F.col("p_size") / F.col("scale"))
    named = fixed_lookup(df, kinds, ["kind"], "inner")
    return named.withColumn("emissions_factor", factor).drop("kind", "p_size", "scale")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company id, name, country and region of every supplier."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    countries = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("asset_country"), "r_name"
    )
    return (
        read(spark, sf_dir, "supplier")
        .join(countries, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.col("s_name").alias("company_name"),
            "asset_country",
            F.col("r_name").alias("region"),
        )
    )


#: Tasks that join or sum one split of the lines. A split is 128 MB at most, so a task's share is bounded as well.
TASKS_PER_SPLIT = 16


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks in proportion to the lines, for steps that hold their rows at many times the size they are shuffled in."""
    return read(spark, sf_dir, "lineitem").rdd.getNumPartitions() * TASKS_PER_SPLIT


def lines_of_kind(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Every line with its kind, year, and quantity before and after returns.

    The part table grows with the data; its size decides how Spark joins it. With
    ``tasks`` the shuffle of that join makes as many partitions.
    """
    returned = F.col("l_returnflag") == "R"
    year = F.year("l_shipdate")
    outside = F.raise_error(F.concat(F.lit("shipped outside the model's years: "), year.cast("string")))
    lines = read(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.when(year.isin(*YEARS), year).otherwise(outside.cast("int")).alias("ship_year"),
        F.col("l_quantity").alias("gross"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("net"),
    )
    if tasks:
        lines = lines.repartition(tasks, "l_partkey")
    return lines.join(part_kinds(spark, sf_dir), "l_partkey").select(
        "l_suppkey", "ship_year", "gross", "net", "kind", "p_size"
    )


def _side_by_side(value: str, prefix: str) -> list[Column]:
    return [
        F.sum(F.when(F.col("ship_year") == y, F.col(value))).alias(f"{prefix}_{y}") for y in YEARS
    ]


def shipped(spark: SparkSession, sf_dir: str, *, spread: bool = False) -> DataFrame:
    """Shipments per supplier and asset kind, years side by side, in one pass over the lines.

    ``_<year>`` is net of returns and makes the production table; ``g_<year>``
    is gross and makes the scenarios. Lines are summed on three numbers; texts
    (kind, supplier name, place) are joined to the sums.

    Rows come placed by supplier, so what sums them by company does so in the same
    stage, several hash tables to a task. ``spread`` then places them over tasks in
    proportion to the lines; by default adaptive execution gives a task up to 64 MB
    of shuffled rows, which those tables hold at more than thirty times the size.
    """
    tasks = line_tasks(spark, sf_dir) if spread else None
    of_kind = lines_of_kind(spark, sf_dir, tasks)
    summed = of_kind.groupBy("l_suppkey", "kind", "p_size").agg(
        *_side_by_side("net", ""), *_side_by_side("gross", "g")
    )
    if tasks:
        summed = summed.repartition(tasks, "l_suppkey")
    placed = with_kind(summed).join(places(spark, sf_dir), "l_suppkey")
    return placed.withColumnRenamed("l_suppkey", "company_id")


def shipped_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``totals`` needs of ``shipped``, for results that read the scenarios alone."""
    kinds = spark.createDataFrame(
        _kinds()[1], "kind int, sector string, technology string, unit string, scale double"
    )
    summed = lines_of_kind(spark, sf_dir).groupBy("l_suppkey", "kind").agg(*_side_by_side("gross", "g"))
    return fixed_lookup(summed.join(places(spark, sf_dir), "l_suppkey"), kinds, ["kind"], "inner")


def production(shipped: DataFrame) -> DataFrame:
    """Wide production table: one column per year, empty where nothing was shipped."""
    return shipped.select(
        "company_id",
        "company_name",
        "sector",
        "asset_country",
        "technology",
        "unit",
        "emissions_factor",
        *[f"_{y}" for y in YEARS],
    )


def totals(shipped: DataFrame) -> DataFrame:
    """Gross shipments per sector, technology, region and year: what scenarios are made from."""
    summed = shipped.groupBy("sector", "technology", "region").agg(
        *[F.sum(f"g_{y}").alias(f"g_{y}") for y in YEARS]
    )
    cells = [cell for y in YEARS for cell in (F.lit(y), F.col(f"g_{y}"))]
    long = summed.select("sector", "technology", "region", F.stack(F.lit(len(YEARS)), *cells).alias("year", "total"))
    return long.where(F.col("total").isNotNull())


def datasets(totals: DataFrame) -> Mapping[str, DataFrame]:
    """Named raw scenario datasets with values at the knot years.

    HydroCap has no value at the middle knot and NuclearCap no first knot.
    """
    scenario_sectors = ("Power", "Automotive", "Steel", "Cement")
    at_knots = totals.where(F.col("sector").isin(*scenario_sectors) & F.col("year").isin(*KNOTS))
    rich = F.col("region").isin(*RICH_REGIONS)
    own = F.when(rich, F.lit("Advanced economies")).otherwise(F.lit("Emerging economies"))
    placed = (
        at_knots.withColumn("scenario_geography", F.explode(F.array(F.lit("World"), own)))
        .groupBy("sector", "technology", "scenario_geography", "year")
        .agg(F.sum("total").alias("total"))
    )
    grows = F.col("technology").isin(*GROWING)

    def factor(up98: float, up01: float, down98: float, down01: float) -> Column:
        return first_match(
            [
                ((F.col("year") == 1998) & grows, F.lit(up98)),
                ((F.col("year") == 2001) & grows, F.lit(up01)),
                (F.col("year") == 1998, F.lit(down98)),
                (F.col("year") == 2001, F.lit(down01)),
            ],
            F.lit(1.0),
        )

    options = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), factor(*steps).alias("factor"))
            for name, steps in AMBITION.items()
        ]
    )
    given = F.when(
        (F.col("technology") != "HydroCap") | (F.col("year") != 1998), F.col("total") * F.col("factor")
    )
    weo = (
        placed.where(F.col("sector").isin("Power", "Automotive"))
        .where((F.col("technology") != "NuclearCap") | (F.col("year") != 1995))
        .select("*", F.inline(options))
        .select(
            F.lit("WEO2022").alias("source"),
            "scenario",
            "sector",
            "technology",
            "scenario_geography",
            F.lit("Production").alias("indicator"),
            F.when(F.col("sector") == "Power", F.lit("MW")).otherwise(F.lit("# vehicles")).alias("units"),
            "year",
            given.alias("value"),
        )
    )
    sector = placed.where(
        F.col("sector").isin("Steel", "Cement")
        & (F.col("scenario_geography") == "World")
        & F.col("year").isin(1995, 2001)
    ).select(
        F.lit("SECTOR2021").alias("source"),
        F.lit("REF").alias("scenario"),
        "sector",
        "technology",
        "scenario_geography",
        F.lit("t").alias("units"),
        "year",
        F.col("total").alias("value"),
    )
    geco = weo.where((F.col("scenario") == "NZE_2050") & (F.col("scenario_geography") == "World")).withColumns(
        {
            "source": F.lit("GECO2021"),
            "value": F.col("value") * 1.5,
            "technology": first_match(
                [(F.col("technology") == car, F.lit(truck)) for car, truck in GECO_TRUCKS.items()], F.col("technology")
            ),
        }
    )
    return {"weo_2022": weo, "sector_2021": sector, "geco_2021": geco}


def pathway(totals: DataFrame) -> DataFrame:
    """Yearly truck pathway under its source's own names."""
    kind = first_match([(F.col("technology") == t, F.lit(k)) for t, k in PATHWAY_KIND.items()])
    trucks = (
        totals.where(F.col("sector") == "HDV")
        .groupBy(kind.alias("kind"), "year")
        .agg(F.sum("total").alias("total"))
    )
    since = F.col("year") - F.lit(YEARS[0])
    turn = F.when(F.col("kind") == "ice", F.lit(-1.0)).otherwise(F.lit(1.0))
    options = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), (1 + turn * F.lit(step) * since).alias("factor"))
            for name, step in PATHWAY_STEP.items()
        ]
    )
    return trucks.select("*", F.inline(options)).select(
        "scenario",
        F.lit("Global").alias("scenario_region"),
        F.col("kind").alias("technology"),
        F.lit("#").alias("unit"),
        "year",
        F.lit(0.0).alias("tmsr"),
        F.lit(0.0).alias("smsp"),
        (F.col("total") * F.col("factor")).alias("value"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of each scenario geography."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    group = F.when(F.col("r_name").isin(*RICH_REGIONS), F.lit("OECD")).otherwise(F.lit("NonOECD"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.explode(F.array(F.lit("Global"), group, F.col("r_name"))).alias("scenario_geography"),
        F.col("n_name").alias("country"),
    )


def bridge(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(BRIDGE), "source string, scenario_geography_source string, scenario_geography_model string"
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed companies are the suppliers that owe nothing; the richest are assessed in two sectors."""
    two = F.col("s_acctbal") >= TWO_SECTOR_BALANCE
    first, second = _pick(ASSESSED, F.col("s_nationkey")), _pick(ASSESSED, F.col("s_nationkey") + 1)
    sectors = F.when(two, F.array(first, second)).otherwise(F.array(first))
    return (
        read(spark, sf_dir, "supplier")
        .where(F.col("s_acctbal") >= 0)
        .select(F.col("s_name").alias("company_name"), F.explode(sectors).alias("sector_assessed"))
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies each report sheet lists: every supplier of the sheet's sector, listed or not."""
    sheets = {"Power": "Electric Utilities", "Automotive": "Autos"}
    two = F.col("s_acctbal") >= TWO_SECTOR_BALANCE
    first, second = _pick(ASSESSED, F.col("s_nationkey")), _pick(ASSESSED, F.col("s_nationkey") + 1)
    sectors = F.when(two, F.array(first, second)).otherwise(F.array(first))
    sheet = first_match(
        [(F.col("sector") == s, F.lit(name)) for s, name in sheets.items()], F.col("sector")
    )
    return (
        read(spark, sf_dir, "supplier")
        .select(F.col("s_name").alias("Company"), F.explode(sectors).alias("sector"))
        .where(F.col("sector") != "HDV")
        .select(sheet.alias("sheet"), "Company")
    )
