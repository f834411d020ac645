from __future__ import annotations

from dataclasses import replace

import pytest

from pathgauge.params import PROFILES, Params, from_config, profile


def test_profiles_overlay_the_default():
    assert profile() == Params()
    run = profile("2023Q2")
    assert (run.reference_year, run.end_year, list(run.relevant_years)) == (2023, 2028, list(range(2023, 2029)))
    assert run.brown_techs == Params().brown_techs  # only the default names them
    assert run.scenario_sources == ("WEO2022", "ETP2017") and run.global_aggregate_sources == ()
    assert "Hybrid" in Params().green_techs and "Hybrid" not in run.green_techs
    assert profile("2022Q2", time_horizon=3).end_year == 2025
    with pytest.raises(KeyError):
        profile("2022Q2", horizon=3)


def test_config_document():
    document = {
        "default": {"time_horizon": 4, "Brown.Techs": ["ICE"], "scenario_agg_score_hdv": "B2DS", "host": "unused"},
        "Q": {
            "market_share_target_reference_year": 2030,
            "global_aggregate_scenario_sources_list": [""],
            "scenario_source_agg_score_auto": "W",
        },
    }
    run = from_config(document, "Q")
    assert (run.reference_year, run.time_horizon, run.brown_techs) == (2030, 4, ("ICE",))
    assert run.global_aggregate_sources == ()
    assert run.score_picks["Automotive"].source == "W" and run.score_picks["Power"].source == "NZE_2021"
    assert run.score_picks["HDV"].only_companies == ("Volvo", "PACCAR, Inc.")
    assert from_config(document, "default").reference_year == 2022


def test_source_choice_and_company_limit_from_a_configuration():
    document = {"default": {"assessed_scenario_sources_list": ["A", "B"], "only_companies_agg_score_hdv": ["V"]}}
    params = from_config(document, "default")
    assert params.assessed_sources == ("A", "B")
    assert params.score_picks["HDV"].only_companies == ("V",)
    assert params.score_picks["Power"].only_companies == ()


@pytest.mark.parametrize("name", list(PROFILES))
def test_picks_are_read(name):
    """The default lists neither source it picks scores from; its user must say which to read."""
    if name == "default":
        with pytest.raises(ValueError, match="NZE_2021"):
            profile(name).check_picks()
        picks = {s: replace(p, source="WEO2021") for s, p in profile().score_picks.items() if s != "HDV"}
        profile(score_picks=picks, assessed_sources=("WEO2021",)).check_picks()
    else:
        profile(name).check_picks()
    with pytest.raises(ValueError, match="WEO2022"):
        profile("2023Q2", assessed_sources=("ETP2017",)).check_picks()
