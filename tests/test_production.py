from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import floor_at_zero, sum0
from pathgauge.operators import unpivot_years
from pathgauge.plans import production as prod

SCHEMA = (
    "company_id long, company_name string, sector string, asset_country string, technology string, "
    "unit string, emissions_factor double, _2022 double, _2023 double"
)


def table(spark, *assets):
    return spark.createDataFrame(list(assets), SCHEMA)


def test_zero_factor(spark):
    wide = table(
        spark,
        (1, "A", "Power", "DE", "HydroCap", "MW", 0.4, 5.0, None),
        (1, "A", "Power", "DE", "CoalCap", "MW", 0.9, 5.0, None),
        (1, "A", "Power", "DE", "NuclearCap", "MW", 0.1, 0.0, -1.0),
        (1, "A", "Power", "DE", None, "MW", 0.3, 1.0, None),
    )
    got = prod.zero_factor(unpivot_years(wide, "ald_production"))
    assert rows(got, "technology", "year", "emissions_factor") == sorted(
        [
            ("HydroCap", 2022, 0.0),
            ("HydroCap", 2023, None),  # unknown production leaves the factor unknown
            ("CoalCap", 2022, 0.9),
            ("CoalCap", 2023, 0.9),
            ("NuclearCap", 2022, 0.1),
            ("NuclearCap", 2023, 0.1),
            (None, 2022, 0.3),
            (None, 2023, 0.3),
        ],
        key=repr,
    )


def test_empty_group_sums_to_zero_and_negative_is_floored(spark):
    wide = table(
        spark,
        (1, "A", "Power", "DE", "CoalCap", "MW", 0.9, None, -3.0),
        (1, "A", "Power", "DE", "CoalCap", "MW", 0.9, None, 1.0),
    )
    assert rows(prod.normalise(wide), "year", "ald_production") == [(2022, 0.0), (2023, 0.0)]


def test_floor_comes_before_equal_names_are_summed(spark):
    wide = table(
        spark,
        (1, "A", "Steel", "DE", "MillGrade", "t", 0.9, -3.0, 1.0),
        (1, "A", "Steel", "DE", "Mill", "t", 0.9, 5.0, 1.0),
        (1, "A", "Coal", "DE", "Thermal", "t", 0.9, 2.0, 1.0),
        (1, "A", "Coal", "DE", "Lignite", "t", 0.9, 2.0, 1.0),
        (1, "A", "Oil&Gas", "DE", "Oil and Condensate", "GJ", 0.9, 2.0, 1.0),
    )
    got = rows(prod.normalise(wide).where("year = 2022"), "technology", "ald_production")
    assert got == [("Coal", 4.0), ("Mill", 5.0), ("Oil", 2.0)]


def test_country_code_na_is_a_country(spark):
    wide = table(spark, (1, "A", "Power", "NA", "CoalCap", "MW", 0.9, 1.0, 1.0))
    assert rows(prod.normalise(wide).where("year = 2022"), "ald_location") == [("NA",)]


def test_wide_sums_equal_the_step_by_step_form(spark):
    """Unpivot, set factors, sum, floor, rename, sum again: one step after the other."""
    techs = ["HydroCap", "CoalCap", "Electric", "Mill", "MillGrade", "Oil and Condensate"]
    values = [None, -2.0, 0.0, 1.0, 4.0]
    assets = [
        (
            i % 3,
            f"C{i % 3}",
            ["Power", "Coal", "Steel"][i % 3],
            ["DE", "NA", None][(i // 3) % 3],
            techs[i % 6],
            "u",
            [0.25, 0.5, None, 0.0][(i // 2) % 4],
            values[i % 5],
            values[(i * 7 + 3) % 5],
        )
        for i in range(240)
    ]
    wide = table(spark, *assets)
    long = prod.zero_factor(unpivot_years(wide, "ald_production"))
    keys = ["company_id", "sector", "asset_country", "technology", "unit", "emissions_factor", "year"]
    step = long.groupBy("company_name", *keys).agg(sum0("ald_production").alias("p"))
    step = step.withColumn("p", floor_at_zero("p")).withColumn(
        "technology",
        F.regexp_replace(
            F.when(F.col("technology") == "Oil and Condensate", "Oil")
            .when(F.col("sector") == "Coal", "Coal")
            .otherwise(F.col("technology")),
            "Grade$",
            "",
        ),
    )
    want = step.groupBy("company_name", *keys).agg(F.sum("p"))
    got = prod.normalise(wide).select(
        "company_name",
        "id",
        "ald_sector",
        "ald_location",
        "technology",
        "ald_production_unit",
        "ald_emissions_factor",
        "year",
        "ald_production",
    )
    assert rows(got) == rows(want)


def test_side_by_side_is_the_inverse_of_year_rows(spark):
    wide = table(spark, (1, "A", "Power", "DE", "CoalCap", "MW", 0.9, 1.0, None))
    long = prod.masterdata(wide, refdata.ZERO_FACTOR_TECHS)
    back = prod.sum_years(prod.side_by_side(long, [2022, 2023]), ["id", "technology"], [2022, 2023])
    assert rows(back) == [(1, "CoalCap", 1.0, 0.0)]


def test_hdv_recode(spark):
    names = list(refdata.HDV_TECH_RECODE) + ["Electric_HDV", "ICE", None]
    df = spark.createDataFrame([(n,) for n in names], "technology string")
    got = [r[0] for r in prod.recode_hdv(df).collect()]
    assert got == list(refdata.HDV_TECH_RECODE.values()) + ["Electric_HDV", "ICE", None]
