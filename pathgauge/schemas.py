"""Column lists of the tables that pass from one stage to the next."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRODUCTION_KEYS = _struct(
    company_id=L,
    company_name=S,
    sector=S,
    asset_country=S,
    technology=S,
    unit=S,
    emissions_factor=D,
)

SCENARIO_RAW = _struct(
    source=S,
    scenario=S,
    sector=S,
    technology=S,
    scenario_geography=S,
    indicator=S,
    units=S,
    year=I,
    value=D,
)

HDV_PATHWAY = _struct(
    scenario=S,
    scenario_region=S,
    technology=S,
    unit=S,
    year=I,
    tmsr=D,
    smsp=D,
    value=D,
)

SCENARIO_INPUT = _struct(
    scenario_source=S,
    scenario=S,
    ald_sector=S,
    technology=S,
    scenario_geography=S,
    indicator=S,
    units=S,
    year=I,
    value=D,
    tmsr=D,
    smsp=D,
    fair_share=D,
)

GEOGRAPHY_BRIDGE = _struct(source=S, scenario_geography_source=S, scenario_geography_model=S)
SCENARIO_REGIONS = _struct(scenario_geography=S, country=S)
ROSTER = _struct(sheet=S, Company=S)

INTENSITY_RESULT = _struct(
    ald_sector=S,
    company_name=S,
    year=I,
    emission_intensity_sector=D,
    scenario=S,
    benchmark_year=I,
    value=D,
    alignment_metric=D,
    alignement_classement=S,
    traffic_light=S,
)

SCORE_RESULT = _struct(
    company_name=S,
    single_score_Case8=D,
    rank=D,
    aggregate_score_class=S,
    aggregate_score_traffic_light=S,
)
