"""A whole run from CSV files to report sheets."""

from __future__ import annotations

import csv
import shutil

import pytest
from conftest import rows
from pyspark.sql import Observation

from pathgauge import __main__ as cli
from pathgauge import refdata, schemas
from pathgauge.params import profile
from pathgauge.sources import tables, workbook
from pathgauge.sources.stages import shared_dir, stage_path, store
from pathgauge.workflow import Run, read_inputs

YEARS = range(2022, 2028)


def write(path, header, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        writer.writerows(data)


def production_rows():
    def asset(id, name, sector, country, tech, factor, values):
        return [id, name, sector, country, tech, "u", factor, *values]

    flat = [10] * 6
    return [
        asset(1, "CEZ as", "Power", "DE", "CoalCap", 0.9, [100, 100, 100, 100, 100, 90]),
        asset(1, "CEZ as", "Power", "NA", "RenewablesCap", 0.1, [50, 60, 70, 80, 90, 200]),
        asset(1, "CEZ as", "Power", "DE", "OilCap", 0.7, [0, 0, 0, 0, 0, 0]),
        asset(2, "Ntpc Ltd.", "Power", "DE", "CoalCap", 0.9, flat),
        asset(2, "Ntpc Ltd.", "Power", "DE", "HydroCap", 0.9, ["", "x", 10, 10, 10, 10]),
        asset(3, "Ford Motor Co.", "Automotive", "DE", "ICE", 0.2, [100, 95, 90, 85, 80, 20]),
        asset(3, "Ford Motor Co.", "Automotive", "DE", "Electric", 0.0, [10, 20, 30, 40, 50, 300]),
        asset(4, "Volvo AB", "HDV", "DE", "ICE Diesel_HDV", 0.2, flat),
        asset(4, "Volvo AB", "HDV", "DE", "ICE CNG_HDV", 0.2, flat),
        asset(5, "POSCO", "Steel", "DE", "Mill", 1.4, flat),
        asset(5, "POSCO", "Steel", "DE", "MillGrade", 3.0, flat),
        asset(6, "CRH Plc", "Cement", "DE", "Kiln", "", flat),
        asset(7, "Not, \"listed\" Co.", "Power", "DE", "CoalCap", 0.9, flat),
    ]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    inputs, output = folder / "in", folder / "out"
    names = [f.name for f in schemas.PRODUCTION_KEYS.fields if f.name not in ("unit", "emissions_factor")]
    assert names == ["company_id", "company_name", "sector", "asset_country", "technology"]
    write(inputs / "production.csv", [*names, "unit", "emissions_factor", *[f"_{y}" for y in YEARS]], production_rows())

    weo = []
    for scenario, coal, green in (("STEPS", 0.9, 1.2), ("APS", 0.7, 1.5), ("NZE_2050", 0.4, 2.0)):
        for sector, brown, clean in (("Power", ["CoalCap", "OilCap"], ["RenewablesCap", "HydroCap"]), ("Automotive", ["ICE"], ["Electric"])):
            for tech in brown + clean:
                end = 1000 * (coal if tech in brown else green)
                for year, value in ((2022, 1000), (2027, end)):
                    weo.append(["WEO2022", scenario, sector, tech, "World", "Capacity", "u", year, value])
    write(inputs / "scenarios/weo_2022.csv", schemas.SCENARIO_RAW.fieldNames(), weo)
    path = [
        [s, "Global", t, "u", y, 0, 0, 100 + (y - 2022) * step * (-1 if t == "ice" else 1)]
        for s, step in (("b2ds", 10), ("sds", 5), ("rts", 1))
        for t in ("electric", "hybrid", "ice", "other")
        for y in YEARS
    ]
    write(inputs / "hdv_pathway.csv", schemas.HDV_PATHWAY.fieldNames(), path)
    write(inputs / "geography_bridge.csv", schemas.GEOGRAPHY_BRIDGE.fieldNames(), [["WEO2022", "World", "Global"]])
    write(inputs / "scenario_regions.csv", schemas.SCENARIO_REGIONS.fieldNames(), [["Global", "DE"], ["Global", "NA"]])
    members = {
        "Electric Utilities": ["CEZ, a.s.", f"NTPC Ltd.{refdata.NO_BREAK_SPACE}", "Unknown"],
        "Autos": ["Ford"],
        "Steel": ["POSCO Holdings Inc.", "None"],
        "Cement": ["CRH plc"],
        "Aviation": ["None"],
    }
    write(inputs / "roster.csv", ["sheet", "Company"], [[s, c] for s, cs in members.items() for c in cs])
    assert cli.main(["--inputs", str(inputs), "--output", str(output), "--profile", "2022Q2"]) == 0
    return output


def read(spark, path):
    return tables.read_text(spark, str(path))


def test_scores(spark, run):
    power = read(spark, run / "power_2022Q2_aggregate.csv")
    got = {r.company_name: (r["rank"], r.aggregate_score_traffic_light) for r in power.collect()}
    assert set(got) == {"CEZ, a.s.", f"NTPC Ltd.{refdata.NO_BREAK_SPACE}"}
    assert {rank for rank, _ in got.values()} == {"1.0", "2.0"}
    auto = read(spark, run / "auto_2022Q2_aggregate.csv").collect()
    assert [(r.company_name, r["rank"], r.aggregate_score_class) for r in auto] == [("Ford", "1.0", "Aligned")]
    hdv = read(spark, run / "hdv_2022Q2_aggregate.csv").collect()
    assert [r.company_name for r in hdv] == ["Volvo"]


def test_stage_tables(spark, run):
    master = spark.read.parquet(str(run / "masterdata"))
    hydro = master.where("technology = 'HydroCap' and year in (2022, 2023)")
    assert rows(hydro, "year", "ald_production") == [(2022, 0.0), (2023, 0.0)]
    assert master.where("ald_location = 'NA'").count() == 6
    connected = spark.read.parquet(str(run / "connected"))
    trucks = connected.where("technology = 'ICE_HDV' and year = 2022")
    assert {r[0] for r in rows(trucks, "plan_tech_prod")} == {20.0}
    assert connected.where("year = 2022 and plan_tech_prod != scen_tech_prod").count() == 0


def test_trajectory_file_has_the_published_names(spark, run):
    got = read(spark, run / "Trajectory_technology_2022Q2.csv")
    assert "Rating_2diU2.CoalCapT" in got.columns and "traffic_light_2diA2.ElectricT" in got.columns
    assert rows(got, "company_name", "`Rating_2diU2.OilCapT`", "`traffic_light_2diA2.ICET`")[0][0] == "CEZ, a.s."


def test_reports(spark, run):
    utilities = read(spark, run / "report/sheet=Electric Utilities")
    by_name = {r["Company"]: r for r in utilities.collect()}
    assert set(by_name) == {"CEZ, a.s.", f"NTPC Ltd.{refdata.NO_BREAK_SPACE}", "Unknown"}
    assert by_name["Unknown"]["1.1 Coal - value"] == "Not Assessed"
    assert by_name["CEZ, a.s."]["1.3 Oil - value"] == "Not Assessed"  # N.A.
    assert by_name["CEZ, a.s."]["1.6 traffic light"] == "Green"
    steel = {r["Company"]: r["1. traffic light"] for r in read(spark, run / "report/sheet=Steel").collect()}
    # Both mill rows carry the clean name but keep their own factor: mean 2.2.
    assert steel == {"POSCO Holdings Inc.": "Amber", "None": refdata.MISSING_LIGHT_TEXT}
    cement = read(spark, run / "report/sheet=Cement").collect()
    assert [(r["Company"], r["1. traffic light"]) for r in cement] == [("CRH plc", "Red")]


def test_report_in_a_template(spark, run, tmp_path):
    """Companies, their order and own columns come from the template; its rows above and other sheets stay."""
    path, notes = str(tmp_path / "template.xlsx"), str(tmp_path / "notes.xlsx")
    cover = spark.createDataFrame([("a note",)], "Title string")
    workbook.write_sheets({"Cover": cover, "Steel": cover}, notes)
    light = refdata.OVERALL_LIGHT_HEADING
    companies = {"Electric Utilities": ["Unknown", "CEZ, a.s."], "Autos": ["Ford"], "Steel": ["None", "POSCO Holdings Inc."], "Cement": ["CRH plc"], "Aviation": ["None"]}
    lists = {
        sheet: spark.createDataFrame([(k, n, None, f"own {k}") for k, n in enumerate(names)], f"at int, Company string, `{light}` string, Ticker string")
        for sheet, names in companies.items()
    }
    start = {s: n + 1 for s, n in refdata.TEMPLATE_SKIP.items()}
    workbook.write_sheets(lists, path, start_rows=start, template=notes, order="at")
    params = profile("2022Q2")
    target = tmp_path / "out"
    shutil.copytree(run, target)
    sheets = Run(spark, str(target), "2022Q2", params).assemble(template=path)
    assert set(sheets) == set(companies)
    book = str(target / "report.xlsx")
    assert workbook.sheet_headings(book, {"Steel": 5}) == {"Steel": ["Company", light, "Ticker", "1. - value"]}
    steel = workbook.read_sheets(spark, book, {"Steel": 5}, f"row int, Company string, Ticker string, `{light}` string")
    assert [tuple(r) for r in steel.collect()] == [(7, "None", "own 0", refdata.MISSING_LIGHT_TEXT), (8, "POSCO Holdings Inc.", "own 1", "Amber")]
    power = workbook.read_sheets(spark, book, {"Electric Utilities": 12}, "Company string, `1.1 Coal - value` string")
    assert [r[0] for r in power.collect()] == ["Unknown", "CEZ, a.s."] and power.first()[1] == "Not Assessed"
    assert [tuple(r) for r in workbook.read_sheets(spark, book, {"Cover": 0}, "Title string").collect()] == [("a note",)]
    assert workbook.sheet_headings(book, {"Steel": 0}) == {"Steel": ["Title"]}
    csv_sheet = read(spark, target / "report/sheet=Steel")
    assert "row" not in csv_sheet.columns and "Ticker" in csv_sheet.columns
    with pytest.raises(ValueError):
        Run(spark, str(target), "2022Q2", params).assemble()


def test_intensity_headings(spark, run):
    got = read(spark, run / "emission_intensity_2022Q2.csv")
    assert {"year.x", "year.y", "alignment_metric"} <= set(got.columns)


def test_communication_plan_file(spark, run):
    got = read(spark, run / "raw_value_communication_plan.csv")
    assert {"plan_tech_prod_2022", "scen_tech_prod_2027", "weighting_factor"} <= set(got.columns)


def test_csv_keeps_quotes_and_outer_blanks(spark, tmp_path):
    names = ['a "quoted", name', " lead", "trail ", f"nbsp{refdata.NO_BREAK_SPACE}", None, "NA"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int")
    tables.write_csv(df, str(tmp_path / "x"))
    back = read(spark, tmp_path / "x").orderBy("i").collect()
    assert [r.n for r in back] == names


def test_stage_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert stage_path(spark, "t") != stage_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    assert rows(store(df, "t")) == [(1, "a"), (2, None)]


def test_numbers_in_text_files(spark, tmp_path):
    header = [*schemas.PRODUCTION_KEYS.fieldNames(), "X_2022"]
    write(
        tmp_path / "p.csv",
        header,
        [
            [7, "A", "Power", "NA", "CoalCap", "MW", "0.5", "1.5"],
            ["8.0", "B", "", "", "CoalCap", "MW", "NA", "NaN"],
            ["2e5", "C", "Power", "DE", "CoalCap", "MW", "", ""],
            ["x", "D", "Power", "DE", "CoalCap", "MW", "0", "0"],
        ],
    )
    got = tables.read_production(spark, str(tmp_path / "p.csv"))
    assert got.columns == header
    assert rows(got, "company_name", "company_id", "asset_country", "emissions_factor", "X_2022") == [
        ("A", 7, "NA", 0.5, 1.5),
        ("B", 8, None, None, None),
        ("C", 200000, "DE", None, None),
        ("D", None, "DE", 0.0, 0.0),
    ]


def test_cells_that_are_no_numbers_are_kept_and_counted(spark, tmp_path):
    header = [*schemas.PRODUCTION_KEYS.fieldNames(), "X_2022", "X_2023"]
    write(
        tmp_path / "in" / "production.csv",
        header,
        [
            ["x1", "A", "Power", "DE", "CoalCap", "MW", "NA", "1.5", "n/a"],
            [2, "B", "Power", "DE", "CoalCap", "MW", "", " ", "NaN"],
            [3, "C", "Power", "DE", "CoalCap", "MW", "0.5", "1,5", "2e3"],
        ],
    )
    checked = tables.with_rejects(tables.read_text(spark, str(tmp_path / "in" / "production.csv")))
    assert checked.columns == [*header, tables.REJECTS]
    counts = Observation("test")
    before = _jobs(spark)
    stored = store(tables.count_rejects(checked, counts), "checked", path=str(tmp_path / "checked"))
    found = counts.get
    assert _jobs(spark) == before + 1  # the counts come with the one job that writes the table
    assert found == {"rows": 3, "company_id": 1, "emissions_factor": 1, "X_2022": 1, "X_2023": 2}
    assert rows(tables.rejects(stored), "company_name", "field", "text") == [
        ("A", "X_2023", "n/a"),
        ("A", "company_id", "x1"),
        ("A", "emissions_factor", "NA"),
        ("B", "X_2023", "NaN"),
        ("C", "X_2022", "1,5"),
    ]
    assert rows(stored.drop(tables.REJECTS)) == rows(tables.read_production(spark, str(tmp_path / "in" / "production.csv")))


def test_a_run_tells_its_rejects(spark, again):
    inputs, output, _ = again
    with open(inputs / "production.csv", "a", encoding="utf-8") as file:
        file.write("9,Odd,Power,DE,CoalCap,u,none,1,1,1,1,1,1\n")
    got = read_inputs(spark, str(inputs), profile("2022Q2"), str(output))
    assert got.reject_counts == {"emissions_factor": 1, "_2023": 1}
    assert rows(got.rejects, "company_name", "field", "text") == [("Ntpc Ltd.", "_2023", "x"), ("Odd", "emissions_factor", "none")]
    assert tables.REJECTS not in got.production.columns
    again = read_inputs(spark, str(inputs), profile("2022Q2"), str(output))
    assert again.reject_counts is None and again.rejects.count() == 2


def test_reading_a_text_file_reads_no_data_to_guess_types(spark, tmp_path):
    write(tmp_path / "r.csv", ["country", "scenario_geography", "other"], [["DE", "Global", "1"]])
    got = tables.read_csv(spark, str(tmp_path / "r.csv"), schemas.SCENARIO_REGIONS)
    assert got.dtypes == [("scenario_geography", "string"), ("country", "string")]
    assert rows(got) == [("Global", "DE")]


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def _files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*") if p.is_file()}


def _stages(folder, before):
    """Stages with files that weren't there."""
    return {name.split("/")[0] for name, at in _files(folder).items() if before.get(name) != at}


@pytest.fixture
def again(spark, run, tmp_path):
    """A copy of the run's folders, prepared once, and how to prepare it again."""
    inputs, output = tmp_path / "in", tmp_path / "out"
    shutil.copytree(run.parent / "in", inputs)

    def prepare(**changes):
        params = profile("2022Q2", **changes)
        tables_in = read_inputs(spark, str(inputs), params, str(output))
        before = _jobs(spark)
        Run(spark, str(output), "2022Q2", params).prepare(tables_in)
        return _jobs(spark) - before

    assert prepare() > 0
    return inputs, output, prepare


def test_a_repeated_run_starts_no_job(again, run):
    _, output, prepare = again
    before = _files(output)
    assert prepare() == 0
    assert _files(output) == before
    assert {n.split("/")[0] for n in before if n.endswith("_manifest.json")} == {
        "production", "masterdata", "name_bridge", "index_regions", "scenario_long", "connected"
    }


def test_a_change_redoes_what_depends_on_it(again):
    inputs, output, prepare = again
    targets = {"Scenario_AnalysisInput.csv", "scenario_long", "connected"}
    for changes, redone in (
        ({"excluded_techs": ()}, {"connected"}),
        ({"excluded_techs": (), "score_picks": {}}, set()),
        ({"excluded_techs": (), "zero_emission_techs": ("Electric",)}, {"masterdata", "connected"}),
        ({"green_techs": ("Electric",)}, {"masterdata", *targets}),
    ):
        before = _files(output)
        prepare(**changes)
        assert _stages(output, before) == redone
    before = _files(output)
    text = (inputs / "hdv_pathway.csv").read_text()
    (inputs / "hdv_pathway.csv").write_text(text.replace("105", "106"))
    prepare(green_techs=("Electric",))
    assert _stages(output, before) == targets
    before = _files(output)
    with open(inputs / "production.csv", "a", encoding="utf-8") as file:
        file.write("8,New,Power,DE,CoalCap,u,0.5,1,1,1,1,1,1\n")
    prepare(green_techs=("Electric",))
    assert _stages(output, before) == {"production", "masterdata", "name_bridge", "index_regions", "connected"}
    # A file that is gone, or a run that was cut short, is noticed too.
    before = _files(output)
    next((output / "index_regions").glob("*.parquet")).unlink()
    (output / "scenario_long" / "_manifest.json").unlink()
    prepare(green_techs=("Electric",))
    assert _stages(output, before) >= {"index_regions", "scenario_long"}
    assert prepare(green_techs=("Electric",)) == 0


def test_one_source_replaced_alone(spark, again):
    inputs, output, prepare = again
    params = profile("2022Q2")
    before = _files(output / "connected")
    old = rows(spark.read.parquet(str(output / "connected")))
    text = (inputs / "hdv_pathway.csv").read_text()
    (inputs / "hdv_pathway.csv").write_text(text.replace(",95", ",50"))
    run = Run(spark, str(output), "2022Q2", params)
    run.replace_source(read_inputs(spark, str(inputs), params, str(output)), "ETP2017")
    after = _files(output / "connected")
    kept = {n: at for n, at in before.items() if n.startswith("scenario_source=WEO2022/")}
    assert kept and kept == {n: at for n, at in after.items() if n.startswith("scenario_source=WEO2022/")}
    assert not {n for n in after if n.startswith("scenario_source=ETP2017/") and n.endswith(".parquet")} & set(before)
    assert "_manifest.json" not in after
    new = rows(spark.read.parquet(str(output / "connected")))
    assert len(new) == len(old) and new != old
    with pytest.raises(ValueError, match="no targets"):
        run.replace_source(read_inputs(spark, str(inputs), params, str(output)), "XYZ")
    prepare()
    assert rows(spark.read.parquet(str(output / "connected"))) == new
