"""Lists that the code and the SQL comparison share, against values written out here."""

from __future__ import annotations

from pathgauge import refdata
from pathgauge.params import profile
from pathgauge.sources.stages import remove_stages, stage_path, store


def test_technology_types():
    kinds = {(sector, tech, kind) for sector, techs in refdata.TECH_TYPES.items() for tech, kind in techs.items()}
    green = {"Power": ["HydroCap", "NuclearCap", "RenewablesCap"], "Automotive": ["Electric", "Hybrid"], "HDV": ["Electric_HDV", "Hybrid_HDV"]}
    brown = {"Power": ["CoalCap", "GasCap", "OilCap"], "Automotive": ["ICE"], "HDV": ["ICE_HDV"]}
    expected = {(s, t, "Green") for s, ts in green.items() for t in ts} | {(s, t, "Brown") for s, ts in brown.items() for t in ts}
    assert kinds == expected


def test_rated_technologies():
    assert {s: set(ts) for s, ts in refdata.RATED_TECHS.items()} == {
        "Power": {"CoalCap", "OilCap", "GasCap", "HydroCap", "NuclearCap", "RenewablesCap"},
        "Automotive": {"ICE", "Hybrid", "Electric", "FuelCell"},
        "HDV": {"ICE_HDV", "Hybrid_HDV", "Electric_HDV", "FuelCell_HDV"},
    }
    assert set(refdata.RATED_SCENARIOS) == {"STEPS", "APS", "NZE_2050", "NPS", "SDS", "B2DS"}
    assert set(refdata.ZERO_FACTOR_TECHS) == {"RenewablesCap", "NuclearCap", "HydroCap", "Electric"}


def test_recoded_technologies():
    ice = {f"ICE {fuel}_HDV" for fuel in ("Propane", "CNG", "Gasoline", "Hydrogen", "Diesel")}
    assert refdata.HDV_TECH_RECODE == {**dict.fromkeys(ice, "ICE_HDV"), "Hybrid No-Plug_HDV": "Hybrid_HDV"}
    mended = {f"{kind}_HDV_HDV": f"{kind}_HDV" for kind in ("Electric", "ICE", "Hybrid")}
    assert refdata.DOUBLED_SUFFIX_RECODE == {**mended, "NA_HDV": "FuelCell_HDV"}


def test_ratings_and_lights():
    lights = {
        "N.A.": None,
        "Aligned with/Below NZE (<1.5°C)": "Green",
        "Aligned with APS (1.5°C - 1.7°C)": "Amber",
        "Above APS (>1.7°C)": "Red",
        "Aligned with /Above STEPS (>2.5°C)": "Red",
        "Aligned to B2DS <1.75°C": "Green",
        "Close to 2DS 1.75C-2°C": "Amber",
        "Above 2DS >2°C": "Red",
        "Significantly above 2DS >2.7°C": "Red",
    }
    assert refdata.RATINGS[0] == (None, None) and dict(refdata.RATINGS[1:]) == lights
    assert len(refdata.RATINGS) == len(lights) + 1


def test_intensity_values():
    assert set(refdata.INTENSITY_SECTORS) == {"Steel", "Cement", "Aviation"}
    assert set(refdata.INTENSITY_EXCLUDED_TECHS) == {"Grinding", "Freight"}
    assert set(refdata.INTENSITY_BENCHMARKS) == {
        ("NZE_2050", "Cement", 2030, 0.44),
        ("NZE_2050", "Steel", 2030, 1.42),
        ("B2DS", "Aviation", 2030, 5.9621956812e-05),
    }
    assert refdata.INTENSITY_BOUNDS == {"Steel": (-0.15, -0.36), "Cement": (-0.05, -0.2), "Aviation": (-0.15, -0.3)}


def test_names_treated_apart():
    assert refdata.AUTOMOTIVE_NOT_REPORTED == ("Volvo AB",)
    assert refdata.HDV_SCORE_DISPLAY_NAMES == {"Volvo AB": "Volvo"}


def test_parameter_lists():
    params = profile("2023Q2")
    assert params.brown_techs == ("ICE", "CoalCap", "GasCap", "OilCap")
    assert params.green_techs == ("FuelCell", "Electric", "RenewablesCap", "FuelCell_HDV", "Electric_HDV", "Hybrid_HDV")
    assert params.most_relevant_techs == ("ICE", "CoalCap", "RenewablesCap", "Electric", "ICE_HDV", "Electric_HDV")
    assert params.assessed_sources == ("WEO2022", "ETP2017")


def test_names_are_written_plainly():
    assert "Électricité de France SA" in refdata.COMPANIES["Power"]


def test_stages_are_removed(spark):
    kept = store(spark.range(3), "kept")
    assert kept.count() == 3
    remove_stages(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_path(spark, "x")).getParent().getParent()
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
