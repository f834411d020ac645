from __future__ import annotations

import math

import pytest
from conftest import rows

from pathgauge import refdata
from pathgauge.params import profile
from pathgauge.plans import intensity as ei
from pathgauge.plans.names import display_name

PARAMS = profile("2022Q2")
FACTS = (
    "id long, ald_sector string, technology string, year int, ald_production double, ald_emissions_factor double"
)


def test_scope_and_weighted_mean(spark):
    facts = spark.createDataFrame(
        [
            (1, "Steel", "BOF", 2022, 1.0, 2.0),
            (7, "Steel", "EAF", 2022, 3.0, 1.0),  # a second id of the same company
            (1, "Steel", "BOF", 2023, 9.0, 9.0),
            (1, "Cement", "Grinding", 2022, 1.0, 1.0),
            (1, "Aviation", "Freight", 2022, 1.0, 1.0),
            (1, "Cement", "Kiln", 2022, 0.0, None),
            (1, "Aviation", "Passenger", 2022, 1.0, None),
            (1, "Aviation", "Passenger", 2022, 1.0, 1.0),
            (1, "Power", "CoalCap", 2022, 1.0, 1.0),
            (9, "Steel", "BOF", 2022, 1.0, 1.0),
        ],
        FACTS,
    )
    bridge = spark.createDataFrame(
        [("A", 1, "Steel"), ("A", 1, "Cement"), ("A", 7, "Steel"), ("A", 7, "Cement")],
        "company_name string, company_id long, sector_assessed string",
    )
    got = ei.company_intensity(facts, bridge, PARAMS)
    assert rows(got, "company_name", "ald_sector", "emission_intensity_sector") == [
        ("A", "Aviation", None),
        ("A", "Cement", None),
        ("A", "Steel", 1.25),
    ]


def scored(spark, sector, value):
    df = spark.createDataFrame(
        [("A", 2022, sector, value)],
        "company_name string, year int, ald_sector string, emission_intensity_sector double",
    )
    return ei.score_intensity(df).collect()[0]


# The intensity that gives a gap g is benchmark / (1 + g).
CASES = [
    ("Aviation", 1.0, "Approaching B2DS (<2.0°C)", "Green"),
    ("Aviation", -0.14, "Approaching B2DS (<2.0°C)", "Green"),
    ("Aviation", -0.16, "Moderate distance to B2DS (<2.0°C)", "Amber"),
    ("Aviation", -0.29, "Moderate distance to B2DS (<2.0°C)", "Amber"),
    ("Aviation", -0.31, "Significant distance to B2DS (<2.0°C)", "Red"),
    ("Cement", -0.04, "Approaching NZE (1.5°C)", "Green"),
    ("Cement", -0.06, "Moderate distance NZE (1.5°C)", "Amber"),
    ("Cement", -0.21, "Significant distance NZE (1.5°C)", "Red"),
    ("Steel", -0.14, "Approaching NZE (1.5°C)", "Green"),
    ("Steel", -0.35, "Moderate distance NZE (1.5°C)", "Amber"),
    ("Steel", -0.37, "Significant distance NZE (1.5°C)", "Red"),
]


@pytest.mark.parametrize(("sector", "gap", "text", "light"), CASES)
def test_classes(spark, sector, gap, text, light):
    benchmark = {s: v for _, s, _, v in refdata.INTENSITY_BENCHMARKS}[sector]
    got = scored(spark, sector, benchmark / (1 + gap))
    assert got.alignment_metric == pytest.approx(gap)
    assert (got.alignement_classement, got.traffic_light) == (text, light)


def test_a_gap_at_the_bound_belongs_to_the_worse_class(spark, monkeypatch):
    # 0.25 and 0.75 are exact in binary, so the gap is exactly the bound.
    monkeypatch.setattr(refdata, "INTENSITY_BENCHMARKS", (("S", "Steel", 2030, 0.75),))
    monkeypatch.setattr(refdata, "INTENSITY_BOUNDS", {"Steel": (-0.25, -0.5)})
    assert scored(spark, "Steel", 1.0).traffic_light == "Amber"
    assert scored(spark, "Steel", 1.5).traffic_light == "Red"


def test_zero_intensity_is_best_and_unknown_is_worst(spark):
    best, worst = scored(spark, "Steel", 0.0), scored(spark, "Steel", None)
    assert (best.alignment_metric, best.traffic_light) == (math.inf, "Green")
    assert (worst.alignment_metric, worst.traffic_light) == (None, "Red")


def test_display_names_change_listed_names_only(spark):
    df = spark.createDataFrame([("POSCO", 1), ("Air France-KLM SA", 2), ("X", 3), (None, 4)], "company_name string, n int")
    got = [r.company_name for r in display_name(df, refdata.INTENSITY_DISPLAY_NAMES).orderBy("n").collect()]
    assert got == ["POSCO Holdings Inc.", "Air France–KLM S.A.", "X", None]


def test_company_list_and_labels():
    assert sum(len(names) for names in refdata.COMPANIES.values()) == 83
    assert len({n for names in refdata.COMPANIES.values() for n in names}) == 82
    assert refdata.SCORE_DISPLAY_NAMES["Ntpc Ltd."] == "NTPC Ltd. "
    assert "  (" in refdata.SCORE_CLASSES["Power"][0]
