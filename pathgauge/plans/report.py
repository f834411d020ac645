"""Report tables: results joined onto the list of companies of each sheet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import text_or

_MARKERS = (refdata.NOT_APPLICABLE,)


def sheet_roster(roster: DataFrame, sector: str) -> DataFrame:
    """Companies of one sheet. Columns other than the sheet name pass through."""
    return roster.where(F.col("sheet") == refdata.REPORT_SHEETS[sector]).drop("sheet")


def technology_report(
    roster: DataFrame, scores: DataFrame, technologies: DataFrame, sector: str
) -> DataFrame:
    """Power or automotive sheet: overall class and light, then two columns per technology."""
    own_scores = scores.where(F.col("ald_sector") == sector).select(
        F.col("company_name").alias("Company"), "aggregate_score_class", "aggregate_score_traffic_light"
    )
    stems = {stem: refdata.tech_key(sector, tech) for stem, _, _, tech in refdata.REPORT_TECHS[sector]}
    own_techs = technologies.where(F.col("ald_sector") == sector)
    if sector == "Automotive":
        own_techs = own_techs.where(~F.col("company_name").isin(*refdata.AUTOMOTIVE_NOT_REPORTED))
    own_techs = own_techs.select(
        F.col("company_name").alias("Company"),
        *[F.col(f"{kind}_{key}") for key in stems.values() for kind in ("Rating", "traffic_light")],
    )
    companies = sheet_roster(roster, sector)
    joined = companies.join(own_scores, "Company", "left").join(own_techs, "Company", "left")
    fallback = refdata.NOT_ASSESSED
    return joined.select(
        *companies.columns,
        text_or("aggregate_score_class", fallback).alias("overall_value"),
        text_or("aggregate_score_traffic_light", fallback, _MARKERS).alias("overall_light"),
        *[
            text_or(f"{kind}_{key}", fallback, _MARKERS).alias(f"{stem}_{suffix}")
            for stem, key in stems.items()
            for kind, suffix in (("Rating", "value"), ("traffic_light", "light"))
        ],
    )


def intensity_report(roster: DataFrame, intensity: DataFrame, sector: str) -> DataFrame:
    """Cement, steel or aviation sheet: light and class.

    Steel and aviation show a heading text where the light is missing; steel
    does so for the class as well, when the gap is unknown. Cement shows blanks.
    """
    own = intensity.where(F.col("ald_sector") == sector).select(
        F.col("company_name").alias("Company"), "alignment_metric", "alignement_classement", "traffic_light"
    )
    light, value = F.col("traffic_light"), F.col("alignement_classement")
    if sector in ("Steel", "Aviation"):
        light = text_or(light, refdata.MISSING_LIGHT_TEXT)
    if sector == "Steel":
        value = F.when(F.col("alignment_metric").isNull(), F.lit(refdata.MISSING_VALUE_TEXT)).otherwise(value)
    companies = sheet_roster(roster, sector)
    return companies.join(own, "Company", "left").select(
        *companies.columns, light.alias("overall_light"), value.alias("overall_value")
    )


def template_roster(cells: DataFrame, sector: str, columns: Sequence[str]) -> DataFrame:
    """Companies of one template sheet, (sheet, row) and the sheet's own columns.

    ``cells`` are rows as ``sources.workbook`` reads them. Columns that the report
    fills are left out; rows without a company are no part of the list.
    """
    own = [c for c in columns if c not in headings(sector).values()]
    named = cells.select("sheet", "row", *[F.col("cells")[c].alias(c) for c in own])
    return named.where((F.col("sheet") == refdata.REPORT_SHEETS[sector]) & F.col("Company").isNotNull())


def filled(sheet: DataFrame, sector: str, columns: Sequence[str]) -> DataFrame:
    """A report under its headings, in the template's order of columns; what that lacks comes last."""
    names = headings(sector)
    named = sheet.select("row", *[F.col(f"`{c}`").alias(names.get(c, c)) for c in sheet.columns if c != "row"])
    there = [c for c in columns if c in named.columns]
    return named.select("row", *[F.col(f"`{c}`") for c in [*there, *[c for c in named.columns if c not in (*there, "row")]]])


def headings(sector: str) -> dict[str, str]:
    """Internal column name to the heading the sheet shows."""
    names = {
        "overall_value": refdata.OVERALL_HEADINGS[sector],
        "overall_light": refdata.OVERALL_LIGHT_HEADING,
    }
    for stem, value_heading, light_heading, _ in refdata.REPORT_TECHS.get(sector, ()):
        names[f"{stem}_value"] = f"{value_heading} - value"
        names[f"{stem}_light"] = f"{light_heading} traffic light"
    return names
