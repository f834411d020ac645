from __future__ import annotations

import pytest
from conftest import rows

from pathgauge import schemas
from pathgauge.params import profile
from pathgauge.plans import scenario

PARAMS = profile("2022Q2", scenario_datasets=("weo_2022",))


def raw(spark, *points, source="WEO2022", scenario="NZE_2050", sector="Power", geography="World"):
    data = [(source, scenario, sector, t, geography, "Capacity", "MW", y, v) for t, y, v in points]
    return spark.createDataFrame(data, schemas.SCENARIO_RAW)


def pathway(spark, *points):
    data = [(s, "Global", t, "#", y, 9.0, 9.0, v) for s, t, y, v in points]
    return spark.createDataFrame(data, schemas.HDV_PATHWAY)


def test_hdv_pathway(spark):
    got = scenario.hdv_pathway(
        pathway(
            spark,
            ("b2ds", "electric", 2022, 1.0),
            ("sds", "hybrid", 2022, 2.0),
            ("rts", "ice", 2021, 3.0),
            ("rts", "ice", 2023, 3.0),
            ("new", "other", 2022, 4.0),
        ),
        PARAMS,
    )
    assert got.columns == schemas.SCENARIO_RAW.fieldNames()
    assert rows(got, "scenario", "technology", "year", "value") == sorted(
        [
            ("B2DS", "Electric_HDV", 2022, 1.0),
            ("SDS", "Hybrid_HDV", 2022, 2.0),
            ("NPS", "ICE_HDV", 2023, 3.0),
            (None, None, 2022, 4.0),
        ],
        key=repr,
    )
    assert rows(got, "source", "sector", "indicator", "units")[0] == ("ETP2017", "HDV", "#", "#")


def test_market_share(spark):
    df = raw(spark, ("CoalCap", 2022, 80.0), ("CoalCap", 2023, 60.0), ("RenewablesCap", 2022, 20.0),
             ("RenewablesCap", 2023, 50.0), ("OilCap", 2022, 0.0), ("OilCap", 2023, 1.0), ("GasCap", 2023, 1.0))
    got = scenario.format_targets(scenario.add_market_share(df, 2022), PARAMS).where("year = 2023")
    assert rows(got, "technology", "tmsr", "smsp", "fair_share") == sorted(
        [
            ("CoalCap", 0.75, -0.2, -0.25),  # all others follow their own ratio
            ("RenewablesCap", 2.5, 0.3, 0.3),  # build-out follows the sector share
            ("OilCap", None, 0.01, None),  # started at 0
            ("GasCap", None, None, None),  # has no start
        ],
        key=repr,
    )


def test_market_share_shuffles_once(spark):
    df = raw(spark, ("CoalCap", 2022, 80.0))
    plan = scenario.add_market_share(df, 2022)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_scenario_input_interpolates_raw_data_only(spark):
    weo = raw(spark, ("CoalCap", 2020, 10.0), ("CoalCap", 2024, 30.0))
    got = scenario.scenario_input(
        {"weo_2022": weo, "not used": weo}, pathway(spark, ("b2ds", "ice", 2022, 5.0), ("b2ds", "ice", 2024, 7.0)), PARAMS
    )
    assert rows(got, "scenario_source", "year", "value") == [
        ("ETP2017", 2022, 5.0),
        ("ETP2017", 2024, 7.0),
        ("WEO2022", 2022, 20.0),
        ("WEO2022", 2023, 25.0),
        ("WEO2022", 2024, 30.0),
    ]


def targets(spark, *data):
    full = [(src, "S", sec, tech, geo, "i", "u", year, 1.0, 1.0, 0.0, 0.0) for src, sec, tech, geo, year in data]
    return spark.createDataFrame(full, schemas.SCENARIO_INPUT)


@pytest.fixture(scope="module")
def dims(spark):
    bridge = spark.createDataFrame(
        [
            ("WEO2022", "World", "Global"),
            ("WEO2022", "Mars", "Nowhere"),
            ("ETP2017", "Global", "Global"),
            ("OLD", "World", "Global"),
        ],
        schemas.GEOGRAPHY_BRIDGE,
    )
    regions = spark.createDataFrame([("Global", "DE"), ("Global", "FR")], schemas.SCENARIO_REGIONS)
    return bridge, regions


def test_scenario_long_filters_and_appends(spark, dims):
    got = scenario.scenario_long(
        targets(
            spark,
            ("WEO2022", "Power", "CoalCap", "World", 2022),
            ("WEO2022", "Power", "CoalCap", "World", 2030),  # after the horizon
            ("WEO2022", "Power", "CoalCap", "Mars", 2022),  # a geography without countries
            ("WEO2022", "Power", "CoalCap", "Moon", 2022),  # not in the bridge
            ("WEO2022", "Shipping", "Boat", "World", 2022),  # sector not in the run
            ("OLD", "Power", "CoalCap", "World", 2022),  # source not in the run
            ("ETP2017", "HDV", "ICE_HDV", "Global", 2022),  # both copies are equal
            ("ETP2017", "HDV", "ICE_HDV", "Global", 2040),  # only the unfiltered copy
            ("ETP2017", "HDV", "ICE_HDV", "Local", 2022),  # only the unfiltered copy
        ),
        *dims,
        PARAMS,
    )
    assert rows(got, "scenario_source", "scenario_geography", "technology", "year") == [
        ("ETP2017", "Global", "ICE_HDV", 2022),
        ("ETP2017", "Global", "ICE_HDV", 2040),
        ("ETP2017", "Local", "ICE_HDV", 2022),
        ("WEO2022", "Global", "CoalCap", 2022),
    ]


def test_doubled_suffixes_and_unnamed_trucks(spark, dims):
    got = scenario.scenario_long(
        targets(
            spark,
            ("ETP2017", "Trucks", "Electric_HDV_HDV", "Global", 2022),
            ("ETP2017", "HDV", "Hybrid_HDV_HDV", "Global", 2022),
            ("ETP2017", "HDV", "NA_HDV", "Global", 2023),
            ("ETP2017", "HDV", None, "Global", 2022),
        ),
        *dims,
        PARAMS,
    )
    assert rows(got, "ald_sector", "technology", "year") == [
        ("HDV", "Electric_HDV", 2022),
        ("HDV", "FuelCell_HDV", 2022),
        ("HDV", "FuelCell_HDV", 2023),
        ("HDV", "Hybrid_HDV", 2022),
    ]


def test_bridge_geography_is_an_inner_join(spark, dims):
    got = scenario.bridge_geography(
        targets(
            spark,
            ("WEO2022", "Power", "CoalCap", "World", 2022),
            ("WEO2022", "Power", "CoalCap", "Moon", 2022),
            ("NEW", "Power", "CoalCap", "World", 2022),
        ),
        dims[0],
    )
    assert rows(got, "scenario_source", "scenario_geography") == [("WEO2022", "Global")]
