from __future__ import annotations

from conftest import rows

from pathgauge import refdata, schemas
from pathgauge.plans import report
from pathgauge.workflow import technology_schema

TECHS = technology_schema()


def technologies(spark, *companies):
    data = []
    for name, sector, cells in companies:
        row = dict.fromkeys(TECHS.fieldNames())
        row |= {"company_name": name, "ald_sector": sector, **cells}
        data.append(tuple(row[c] for c in TECHS.fieldNames()))
    return spark.createDataFrame(data, TECHS)


def roster(spark, *companies):
    return spark.createDataFrame(list(companies), schemas.ROSTER)


def scores(spark, *data):
    return spark.createDataFrame(
        list(data),
        "ald_sector string, company_name string, aggregate_score_class string, aggregate_score_traffic_light string",
    )


def test_power_sheet(spark):
    got = report.technology_report(
        roster(spark, ("Electric Utilities", "A"), ("Electric Utilities", "B"), ("Electric Utilities", "C"), ("Autos", "A")),
        scores(spark, ("Power", "A", "Aligned", "Green"), ("Power", "B", None, "N.A."), ("HDV", "C", "Aligned", "Green")),
        technologies(
            spark,
            ("A", "Power", {"Rating_2diU2_CoalCapT": "N.A.", "Rating_2diU2_OilCapT": "Above", "traffic_light_2diU2_OilCapT": "Red"}),
            ("A", "Automotive", {"Rating_2diU2_GasCapT": "wrong sector"}),
        ),
        "Power",
    )
    assert len(got.columns) == 1 + 14
    none = refdata.NOT_ASSESSED
    assert rows(got, "Company", "overall_value", "overall_light", "coal_value", "oil_value", "oil_light", "gas_value") == [
        ("A", "Aligned", "Green", none, "Above", "Red", none),
        ("B", none, none, none, none, none, none),
        ("C", none, none, none, none, none, none),
    ]
    headings = report.headings("Power")
    assert [headings.get(c, c) for c in got.columns][:5] == [
        "Company",
        "1. Capacity Alignment with 1.5°C - value",
        "1. traffic light",
        "1.1 Coal - value",
        "1.1 traffic light",
    ]
    assert headings["renewables_light"] == "1.6 traffic light" and headings["gas_value"] == "1.2 Natural Gas - value"


def test_automotive_sheet_leaves_one_company_out(spark):
    got = report.technology_report(
        roster(spark, ("Autos", "Volvo AB"), ("Autos", "B")),
        scores(spark, ("Automotive", "Volvo AB", "Aligned", "Green")),
        technologies(
            spark,
            ("Volvo AB", "Automotive", {"Rating_2diA2_ICET": "x"}),
            ("B", "Automotive", {"Rating_2diA2_ICET": "x"}),
        ),
        "Automotive",
    )
    assert len(got.columns) == 1 + 8
    assert rows(got, "Company", "overall_value", "ice_value") == [
        ("B", "Not Assessed", "x"),
        ("Volvo AB", "Aligned", "Not Assessed"),
    ]


def test_intensity_sheets(spark):
    names = ("A", "B", "C")
    results = spark.createDataFrame(
        [("A", s, 0.1, "Approaching", "Green") for s in ("Cement", "Steel", "Aviation")]
        + [("B", s, None, "Significant", "Red") for s in ("Cement", "Steel", "Aviation")],
        "company_name string, ald_sector string, alignment_metric double, alignement_classement string, traffic_light string",
    )

    def sheet(sector):
        companies = roster(spark, *[(sector, n) for n in names])
        return rows(report.intensity_report(companies, results, sector))

    light, value = refdata.MISSING_LIGHT_TEXT, refdata.MISSING_VALUE_TEXT
    assert sheet("Cement") == [("A", "Green", "Approaching"), ("B", "Red", "Significant"), ("C", None, None)]
    assert sheet("Steel") == [("A", "Green", "Approaching"), ("B", "Red", value), ("C", light, value)]
    assert sheet("Aviation") == [("A", "Green", "Approaching"), ("B", "Red", "Significant"), ("C", light, None)]


def test_columns_of_the_roster_pass_through(spark):
    companies = spark.createDataFrame([("Steel", "A", "note")], "sheet string, Company string, remark string")
    results = spark.createDataFrame(
        [],
        "company_name string, ald_sector string, alignment_metric double, alignement_classement string, traffic_light string",
    )
    got = report.intensity_report(companies, results, "Steel")
    assert got.columns == ["Company", "remark", "overall_light", "overall_value"]
