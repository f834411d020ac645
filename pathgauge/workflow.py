"""The yearly run, step by step: prepare, score, trajectory, intensity, assemble.

Each step reads stored tables and stores its own, so a step can be repeated
alone, and work that is stored is never lost with an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathgauge import refdata, schemas
from pathgauge.params import Params
from pathgauge.plans import connect as conn
from pathgauge.plans import intensity as ei
from pathgauge.plans import production as prod
from pathgauge.plans import report, scenario, score, trajectory
from pathgauge.sources import layout, manifest, tables, workbook
from pathgauge.sources.stages import store

# Tables placed by company id.
_PLACED = ("name_bridge", "connected")

# File stem of each sector's score result.
_SCORE_FILES = {"Power": "power", "Automotive": "auto", "HDV": "hdv"}
_INTENSITY_HEADINGS = {"year": "year.x", "benchmark_year": "year.y"}


@dataclass(frozen=True)
class Inputs:
    """Input tables. ``scenarios`` holds the raw datasets by name.

    ``companies_name`` says which fixed list ``companies`` is, if it is one and not read from files.
    """

    production: DataFrame
    scenarios: Mapping[str, DataFrame]
    pathway: DataFrame
    geography_bridge: DataFrame
    scenario_regions: DataFrame
    companies: DataFrame
    companies_name: str | None = None
    #: Cells of the production file that could not be read, and their number by column, None if an earlier run parsed it.
    rejects: DataFrame | None = None
    reject_counts: Mapping[str, int] | None = None


def read_inputs(spark: SparkSession, folder: str, params: Params, run_folder: str) -> Inputs:
    """Inputs from one folder of CSV files.

    ``production.csv``, ``scenarios/<dataset>.csv`` for every configured dataset,
    ``hdv_pathway.csv``, ``geography_bridge.csv`` and ``scenario_regions.csv``.
    The assessed companies are the fixed list of the model. The production file
    is parsed once and kept as a column store in the run's folder, as three stages
    read parts of it; a repeated run overwrites it if the file has changed.
    """
    checked = tables.with_rejects(tables.read_text(spark, f"{folder}/production.csv"))
    path, counts = f"{run_folder.rstrip('/')}/production", {}

    def parse() -> DataFrame:
        seen = Observation("production")
        table = store(tables.count_rejects(checked, seen), "production", path=path)
        counts.update(seen.get)
        return table

    production, _ = manifest.kept(spark, path, {"file": manifest.identity(checked)}, parse)
    return Inputs(
        production=production.drop(tables.REJECTS),
        rejects=tables.rejects(production),
        reject_counts={c: n for c, n in counts.items() if n and c != "rows"} if counts else None,
        scenarios={
            name: tables.read_csv(spark, f"{folder}/scenarios/{name}.csv", schemas.SCENARIO_RAW)
            for name in params.scenario_datasets
        },
        pathway=tables.read_csv(spark, f"{folder}/hdv_pathway.csv", schemas.HDV_PATHWAY),
        geography_bridge=tables.read_csv(
            spark, f"{folder}/geography_bridge.csv", schemas.GEOGRAPHY_BRIDGE
        ),
        scenario_regions=tables.read_csv(
            spark, f"{folder}/scenario_regions.csv", schemas.SCENARIO_REGIONS
        ),
        companies=refdata.companies(spark),
        companies_name=manifest.digest(refdata.COMPANIES),
    )


@dataclass(frozen=True)
class Run:
    """One run: where its tables are stored, and under which profile name and parameters."""

    spark: SparkSession
    folder: str
    name: str
    params: Params

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def table(self, table: str) -> DataFrame:
        if table in _PLACED:
            return layout.read_placed(self.spark, self.path(table))
        return self.spark.read.parquet(self.path(table))

    def _kept(self, name: str, made_from: Mapping[str, object], make: Callable[[], DataFrame], **options):
        """A stage of this run, made by ``make`` unless it is there already, made from the same."""
        path = self.path(name)
        return manifest.kept(self.spark, path, made_from, lambda: store(make(), name, path=path, **options))

    def _kept_placed(self, name: str, made_from: Mapping[str, object], write: Callable[[str], DataFrame]):
        path = self.path(name)
        return manifest.kept(self.spark, path, made_from, lambda: write(path), lambda: self.table(name))

    def _picked(self, *names: str) -> dict[str, object]:
        return {name: asdict(self.params)[name] for name in names}

    def prepare(self, inputs: Inputs) -> None:
        """Clean production, scenario targets, company bridge and the connected table.

        A table that an earlier run left here is used again if its inputs' files
        and the parameters it depends on are the same, see ``sources/manifest.py``.
        """
        self.params.check_picks()
        masterdata, bridge, markets, production = self._production_stages(inputs)
        long, targets = self._target_stage(inputs)
        regions = manifest.identity(inputs.scenario_regions)
        made_from = {"production": production, "targets": targets, "regions": regions, "params": self._connect_params()}
        self._kept_placed(
            "connected", made_from, lambda path: self._connect(inputs, masterdata, bridge, markets, long, path=path)
        )

    def _production_stages(self, inputs: Inputs) -> tuple[DataFrame, DataFrame, DataFrame, list[str] | None]:
        """Masterdata, name bridge and markets, and what a later stage takes as their identity."""
        params, wide = self.params, inputs.production
        production, companies = manifest.identity(wide), inputs.companies_name or manifest.identity(inputs.companies)
        masterdata, one = self._kept(
            "masterdata",
            {"production": production, "params": self._picked("zero_emission_techs", "exact_sums")},
            lambda: prod.masterdata(wide, params.zero_emission_techs, exact=params.exact_sums, ordered=True),
            blooms=("id",),
        )
        bridge, two = self._kept_placed(
            "name_bridge",
            {"production": production, "companies": companies, "params": self._picked("company_buckets")},
            lambda path: conn.store_placed_bridge(conn.name_bridge(wide, inputs.companies), params.company_buckets, path),
        )
        markets, three = self._kept("index_regions", {"production": production}, lambda: conn.index_regions(wide))
        return masterdata, bridge, markets, None if None in (one, two, three) else [one, two, three]

    def _target_stage(self, inputs: Inputs) -> tuple[DataFrame, str | None]:
        params = self.params
        named = {name: manifest.identity(inputs.scenarios[name]) for name in params.scenario_datasets}
        others = [manifest.identity(df) for df in (inputs.pathway, inputs.geography_bridge, inputs.scenario_regions)]
        known = None if None in (*named.values(), *others) else [named, others]

        def make() -> DataFrame:
            targets = scenario.scenario_input(inputs.scenarios, inputs.pathway, params)
            file = self.path("Scenario_AnalysisInput.csv")
            tables.write_csv(targets, file)
            stored = tables.read_csv(self.spark, file, schemas.SCENARIO_INPUT)
            return scenario.scenario_long(stored, inputs.geography_bridge, inputs.scenario_regions, params)

        names = ("reference_year", "time_horizon", "scenario_sources", "scenario_datasets", "sectors", "other_sectors")
        own = self._picked(*names, "green_techs", "pathway_source", "exact_sums")
        return self._kept("scenario_long", {"inputs": known, "params": own}, make)

    def _connect_params(self) -> dict[str, object]:
        names = ("reference_year", "time_horizon", "sectors", "other_sectors", "excluded_techs", "scenario_geographies")
        more = ("global_aggregate_sources", "global_aggregate_sectors", "green_techs", "exact_sums", "complete_technologies", "company_buckets")
        return self._picked(*names, *more)

    def _connect(self, inputs, masterdata, bridge, markets, long, *, path: str, keep_other: bool = False) -> DataFrame:
        listed = conn.in_scope(masterdata, bridge, ids=conn.listed_ids(bridge))
        assets = prod.recode_hdv(prod.side_by_side(listed, self.params.relevant_years))
        connected = conn.connect(assets, long, inputs.scenario_regions, markets, self.params)
        return conn.store_placed_per_source(connected, self.params.company_buckets, path, keep_other)

    def replace_source(self, inputs: Inputs, source: str) -> None:
        """Make the connected rows of one scenario source anew; the files of the others stay as they are.

        Its targets are made from the given inputs. The next ``prepare`` makes the
        whole table again unless it is left out, as the sources no longer are of one run.
        """
        masterdata, bridge, markets, _ = self._production_stages(inputs)
        long, _ = self._target_stage(inputs)
        own = long.where(F.col("scenario_source") == source)
        if own.isEmpty():
            raise ValueError(f"no targets of source {source!r}")
        path = self.path("connected")
        manifest.forget(self.spark, path)
        self._connect(inputs, masterdata, bridge, markets, own, path=path, keep_other=True)

    def connected(self) -> DataFrame:
        """Plans and targets of the sources that scores and ratings are made from."""
        return conn.assessed(self.table("connected").select(*conn.CONNECTED_COLUMNS), self.params)

    def score(self) -> None:
        """Aggregate score per sector, and the communication table."""
        self.params.check_picks()
        bridge = self.table("name_bridge")
        result = store(
            score.score_result(score.company_scores(self.connected(), bridge, self.params)),
            "score",
            partition_by="ald_sector",
            path=self.path("score"),
        )
        for sector, stem in _SCORE_FILES.items():
            own = result.where(F.col("ald_sector") == sector).select(*schemas.SCORE_RESULT.fieldNames())
            tables.write_csv(own, self.path(f"{stem}_{self.name}_aggregate.csv"))
        scored = score.scored_technologies(self.connected(), bridge, self.params)
        tables.write_csv(
            score.communication_plan(scored, self.params), self.path("raw_value_communication_plan.csv")
        )

    def trajectory(self) -> None:
        """Rating and traffic light per technology."""
        techs = self.techs()
        result = trajectory.technology_result(self.connected(), self.table("name_bridge"), self.params, techs)
        tables.write_csv(
            trajectory.sorted_result(result),
            self.path(f"Trajectory_technology_{self.name}.csv"),
            technology_headings(techs),
        )

    def techs(self) -> dict[str, tuple[str, ...]]:
        """Rated technologies per sector, those of the run's targets included."""
        return trajectory.run_techs(self.table("scenario_long"))

    def intensity(self) -> None:
        """Emission intensity against the benchmark."""
        bridge = self.table("name_bridge")
        result = ei.intensity_result(self.table("masterdata"), bridge, self.params, conn.listed_ids(bridge))
        tables.write_csv(result, self.path(f"emission_intensity_{self.name}.csv"), _INTENSITY_HEADINGS)

    def assemble(self, roster: DataFrame | None = None, template: str | None = None) -> dict[str, DataFrame]:
        """Report table of every sheet, also written as one CSV per sheet.

        The companies of each sheet come from ``roster``, or from a workbook
        ``template``, whose rows, columns and what stands above them are kept; then
        all sheets also make one workbook, ``report.xlsx``.
        """
        if (roster is None) == (template is None):
            raise ValueError("either a roster or a template lists the companies")
        if template:
            cells = workbook.read_sheets(self.spark, template, refdata.TEMPLATE_SKIP)
            columns = workbook.sheet_headings(template, refdata.TEMPLATE_SKIP)
        spark, techs = self.spark, self.techs()
        technologies = tables.read_csv(
            spark,
            self.path(f"Trajectory_technology_{self.name}.csv"),
            technology_schema(techs),
            technology_headings(techs),
        )
        intensities = tables.read_csv(
            spark,
            self.path(f"emission_intensity_{self.name}.csv"),
            schemas.INTENSITY_RESULT,
            _INTENSITY_HEADINGS,
        )
        sheets, in_template = {}, {}
        for sector, sheet in refdata.REPORT_SHEETS.items():
            if template:
                roster = report.template_roster(cells, sector, columns[sheet])
            if sector in refdata.REPORT_TECHS:
                scores = tables.read_csv(
                    spark,
                    self.path(f"{_SCORE_FILES[sector]}_{self.name}_aggregate.csv"),
                    schemas.SCORE_RESULT,
                ).withColumn("ald_sector", F.lit(sector))
                sheets[sheet] = report.technology_report(roster, scores, technologies, sector)
            else:
                sheets[sheet] = report.intensity_report(roster, intensities, sector)
            if template:
                in_template[sheet] = report.filled(sheets[sheet], sector, columns[sheet])
                sheets[sheet] = sheets[sheet].drop("row")
            tables.write_csv(
                sheets[sheet], self.path(f"report/sheet={sheet}"), report.headings(sector)
            )
        if template:
            workbook.write_sheets(
                in_template,
                self.path("report.xlsx"),
                start_rows={s: n + 1 for s, n in refdata.TEMPLATE_SKIP.items()},
                template=template,
                order="row",
            )
        return sheets


def technology_schema(techs: Mapping[str, Sequence[str]] = refdata.RATED_TECHS) -> T.StructType:
    names = ["company_name", "ald_sector"]
    for kind in ("Rating", "traffic_light"):
        for sector in techs:
            names += [f"{kind}_{key}" for key in trajectory.rated_columns(sector, techs)]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def technology_headings(techs: Mapping[str, Sequence[str]] = refdata.RATED_TECHS) -> dict[str, str]:
    """Columns whose name in the file holds a dot, which a column here does not."""
    return {
        name: name.replace("2_", "2.", 1) for name in technology_schema(techs).fieldNames() if "2di" in name
    }
