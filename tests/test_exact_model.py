"""Scores, ratings and intensities bit for bit, however the production rows are partitioned."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pathgauge.plans import connect as conn
from pathgauge.plans import intensity, score, trajectory
from pathgauge.plans import production as prod
from testbed import model, queries

SF_DIR = "/root/testdata/sf0.001"
PARAMS = replace(model.PARAMS, exact_sums=True)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def outcome(spark, wide, parts):
    """All numbers of a run over ``wide`` dealt into ``parts`` partitions, in another order each time."""
    wide = wide.repartition(parts, F.xxhash64(F.lit(parts), *wide.columns))
    listed = queries._stored_bridge(spark, SF_DIR, wide)
    scoped = conn.in_scope(wide, listed, "company_id")
    assets = prod.asset_sums(scoped, years=(PARAMS.reference_year, PARAMS.end_year), exact=True)
    targets = queries._scenario_long(spark, SF_DIR, queries._shipped(spark, SF_DIR))
    connected = conn.assessed(
        conn.connect(
            prod.recode_hdv(assets),
            targets,
            model.regions(spark, SF_DIR),
            conn.index_regions(wide),
            PARAMS,
            years=(PARAMS.reference_year, PARAMS.end_year),
        ),
        PARAMS,
    )
    masterdata = prod.masterdata(scoped, PARAMS.zero_emission_techs, years=[PARAMS.reference_year], exact=True)
    found = [
        score.company_scores(connected, listed, PARAMS).select("ald_sector", "company_name", "single_score_Case8"),
        trajectory.rated(connected, PARAMS).select("id", "ald_sector", "technology", "plan_tech_prod", "Scen_Rating"),
        intensity.company_intensity(masterdata, listed, PARAMS),
    ]
    return [sorted((tuple(v.hex() if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr) for df in found]


def test_same_bits_for_1_8_and_200_partitions(spark):
    shipped = queries._shipped(spark, SF_DIR)
    wide = model.production(shipped)
    uneven = (1 + F.pmod(F.xxhash64("company_id", "technology", "emissions_factor"), F.lit(997))) / 7.0
    wide = wide.select(*[(F.col(c) * uneven).alias(c) if c.startswith("_") else c for c in wide.columns])
    first = outcome(spark, wide, 1)
    assert all(first)
    assert outcome(spark, wide, 8) == first
    assert outcome(spark, wide, 200) == first
