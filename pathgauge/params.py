"""Run parameters: one frozen record, built as a default overlaid by a profile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class ScorePick:
    """Scenario that a sector's aggregate score is read from."""

    source: str
    scenario: str
    only_companies: tuple[str, ...] = ()


# Defaults and named profiles of the workflow.
@dataclass(frozen=True)
class Params:
    reference_year: int = 2022
    time_horizon: int = 5
    scenario_sources: tuple[str, ...] = ("ETP2020", "GECO2021", "IPR2021", "ISF2021", "WEO2021")
    sectors: tuple[str, ...] = ("Automotive", "Power", "Fossil Fuels", "Oil&Gas", "Coal", "HDV")
    other_sectors: tuple[str, ...] = ("Steel", "Aviation", "Cement")
    zero_emission_techs: tuple[str, ...] = ("Electric", "HydroCap", "NuclearCap", "RenewablesCap")
    green_techs: tuple[str, ...] = (
        "FuelCell",
        "Electric",
        "Hybrid",
        "RenewablesCap",
        "HydroCap",
        "NuclearCap",
        "FuelCell_HDV",
        "Electric_HDV",
    )
    scenario_datasets: tuple[str, ...] = ("etp_2020", "geco_2021", "ipr_2021", "isf_2021", "weo_2021")
    excluded_techs: tuple[str, ...] = (
        "OtherCap",
        "OtherFF",
        "Coking Plant",
        "Sintering Plant",
        "Direct Or Smelting Reduction Plant",
        "Pelletizing Plant",
        "Grinding Plant",
        "Passenger / Freight",
    )
    scenario_geographies: tuple[str, ...] = ("Global", "NonOECD", "OECD")
    global_aggregate_sources: tuple[str, ...] = ("ETP2020", "GECO2021", "IPR2021", "ISF2021", "WEO2021")
    global_aggregate_sectors: tuple[str, ...] = ("Power",)
    pathway_source: str = "ETP2017"
    assessed_sources: tuple[str, ...] = ("WEO2022", "ETP2017")
    brown_techs: tuple[str, ...] = ("ICE", "CoalCap", "GasCap", "OilCap")
    most_relevant_techs: tuple[str, ...] = (
        "ICE",
        "CoalCap",
        "RenewablesCap",
        "Electric",
        "ICE_HDV",
        "Electric_HDV",
    )
    score_picks: Mapping[str, ScorePick] = field(
        default_factory=lambda: {
            "Power": ScorePick("NZE_2021", "NZE_2050"),
            "Automotive": ScorePick("NZE_2021", "NZE_2050"),
            "HDV": ScorePick("ETP2017", "B2DS", ("Volvo", "PACCAR, Inc.")),
        }
    )

    #: Sums that come out the same however the rows are partitioned; see ``functions/exact.py``.
    exact_sums: bool = False
    #: A row, with a plan of 0, also for target technologies a company has no asset of.
    complete_technologies: bool = False
    #: Buckets of the tables that are placed by company id; for longer lists of companies, more.
    company_buckets: int = 8

    @property
    def end_year(self) -> int:
        return self.reference_year + self.time_horizon

    @property
    def relevant_years(self) -> range:
        return range(self.reference_year, self.end_year + 1)

    def check_picks(self) -> None:
        """An error if a score is to be read from a scenario source that the run leaves out.

        Such a score would come out empty without a word. Sources are read if they
        are listed (the truck pathway always is) and assessed.
        """
        read = {*self.scenario_sources, self.pathway_source} & set(self.assessed_sources)
        unread = {sector: pick.source for sector, pick in self.score_picks.items() if pick.source not in read}
        if unread:
            raise ValueError(f"scores picked from sources that are not read: {unread}; read are {sorted(read)}")

    @property
    def all_sectors(self) -> tuple[str, ...]:
        return self.sectors + self.other_sectors


_RELEASE = {
    "scenario_sources": ("WEO2022", "ETP2017"),
    "scenario_datasets": ("weo_2022",),
    "global_aggregate_sources": (),
    "zero_emission_techs": ("Electric", "RenewablesCap"),
    "green_techs": (
        "FuelCell",
        "Electric",
        "RenewablesCap",
        "FuelCell_HDV",
        "Electric_HDV",
        "Hybrid_HDV",
    ),
    "score_picks": {
        "Power": ScorePick("WEO2022", "NZE_2050"),
        "Automotive": ScorePick("WEO2022", "NZE_2050"),
        "HDV": ScorePick("ETP2017", "B2DS", ("Volvo", "PACCAR, Inc.")),
    },
}

PROFILES: dict[str, dict] = {
    "default": {},
    "2022Q2": {**_RELEASE, "reference_year": 2022},
    "2023Q2": {**_RELEASE, "reference_year": 2023},
}


def profile(name: str = "default", **overrides) -> Params:
    """Named profile over the default, with any key overridden by the caller."""
    known = {f.name for f in fields(Params)}
    values = {**PROFILES[name], **overrides}
    unknown = set(values) - known
    if unknown:
        raise KeyError(f"unknown parameters: {sorted(unknown)}")
    return replace(Params(), **values)


# Names used in a workflow configuration file, and the field each one sets.
CONFIG_KEYS = {
    "market_share_target_reference_year": "reference_year",
    "time_horizon": "time_horizon",
    "scenario_sources_list": "scenario_sources",
    "sector_list": "sectors",
    "other_sector_list": "other_sectors",
    "zero_emission_factor_techs": "zero_emission_techs",
    "green_techs": "green_techs",
    "scenario_raw_data_to_include": "scenario_datasets",
    "tech_exclude": "excluded_techs",
    "scenario_geographies_list": "scenario_geographies",
    "global_aggregate_scenario_sources_list": "global_aggregate_sources",
    "assessed_scenario_sources_list": "assessed_sources",
    "global_aggregate_sector_list": "global_aggregate_sectors",
    "Brown.Techs": "brown_techs",
    "Most.Relevant.Techs": "most_relevant_techs",
    "exact_sums": "exact_sums",
    "complete_technologies": "complete_technologies",
    "company_buckets": "company_buckets",
}

_SCORE_CONFIG_SUFFIX = {"Power": "", "Automotive": "_auto", "HDV": "_hdv"}


def from_config(document: Mapping[str, Mapping], name: str) -> Params:
    """Params from a parsed configuration file: its default section overlaid by ``name``."""
    merged = {**document.get("default", {}), **(document.get(name, {}) if name != "default" else {})}
    values = {}
    for key, attribute in CONFIG_KEYS.items():
        if key in merged:
            value = merged[key]
            values[attribute] = tuple(v for v in value if v != "") if isinstance(value, list) else value
    picks = dict(Params().score_picks)
    for sector, suffix in _SCORE_CONFIG_SUFFIX.items():
        picks[sector] = replace(
            picks[sector],
            source=merged.get(f"scenario_source_agg_score{suffix}", picks[sector].source),
            scenario=merged.get(f"scenario_agg_score{suffix}", picks[sector].scenario),
            only_companies=tuple(merged.get(f"only_companies_agg_score{suffix}", picks[sector].only_companies)),
        )
    return replace(Params(), score_picks=picks, **values)
