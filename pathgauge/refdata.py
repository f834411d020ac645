"""Company lists, labels, thresholds and recodes of the model.

Everything here is a short literal whose size does not depend on the input, so
the tables built from it are the only ones the library marks for broadcast
without looking at their size first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NO_BREAK_SPACE = "\u00a0"
EN_DASH = "\u2013"
APOSTROPHE = "\u2019"

# --- fixed values: companies and the sector each is assessed in ---------------

COMPANIES: dict[str, tuple[str, ...]] = {
    "Power": (
        "The AES Corp.",
        "American Electric Power Co., Inc.",
        "CEZ as",
        "Dominion Energy, Inc.",
        "Duke Energy Corp.",
        "E.ON SE",
        "Électricité de France SA",
        "Enel SpA",
        "ENGIE SA",
        "Eskom Holdings SOC Ltd.",
        "Exelon Corp.",
        "FirstEnergy Corp.",
        "Fortum Oyj",
        "Iberdrola SA",
        "Korea Electric Power Corp.",
        "National Grid Plc",
        "NextEra Energy, Inc.",
        "NRG Energy, Inc.",
        "Ntpc Ltd.",
        "PGE Polska Grupa Energetyczna SA",
        "Power Assets Holdings Ltd.",
        "PPL Corp.",
        "RWE AG",
        "SSE Plc",
        "The Southern Co.",
        "Vistra Corp.",
        "WEC Energy Group, Inc.",
        "Xcel Energy, Inc.",
        "AGL Energy Ltd.",
        "Naturgy Energy Group SA",
        "Uniper SE",
        "Berkshire Hathaway, Inc.",
        "Centrica Plc",
        "POSCO",
        "Constellation Energy Generation LLC",
        "Origin Energy Ltd.",
    ),
    "Automotive": (
        "Bayerische Motoren Werke AG",
        "Daimler AG",
        "Ford Motor Co.",
        "General Motors Co.",
        "Honda Motor Co., Ltd.",
        "Nissan Motor Co., Ltd.",
        "Renault SA",
        "SAIC Motor Corp. Ltd.",
        "Suzuki Motor Corp.",
        "Toyota Motor Corp.",
        "Volkswagen AG",
        "Rolls-Royce Group Plc",
        "Peugeot Sa",
        "Fiat Chrysler Automobiles NV",
        "Stellantis NV",
        "Mercedes-Benz Group AG",
        "PACCAR, Inc.",
    ),
    "HDV": ("Volvo AB", "PACCAR, Inc."),
    "Aviation": (
        "Air France-KLM SA",
        "American Airlines Group, Inc.",
        "Delta Air Lines, Inc.",
        "United Airlines Holdings, Inc.",
        "Qantas Airways Ltd.",
    ),
    "Cement": (
        "Anglo American Plc",
        "Anhui Conch Cement Co., Ltd.",
        "Boral Ltd.",
        "CEMEX SAB de CV",
        "Dangote Cement Plc",
        "Heidelberg Materials AG",
        "Hitachi Cement",
        "Holcim Ltd.",
        "UltraTech Cement Ltd.",
        "ADBRI Ltd.",
        "CRH Plc",
        "Adelaide Brighton",
        "Grupo Argos SA",
    ),
    "Steel": (
        "ArcelorMittal SA",
        "Bhp Group Plc",
        "BlueScope Steel Ltd.",
        "Martin Marietta Materials, Inc.",
        "Rio Tinto Ltd.",
        "thyssenkrupp AG",
        "China Steel Corp.",
        "NIPPON STEEL CORP.",
        "Severstal PAO",
        "SSAB AB",
    ),
}

# --- fixed values: names shown in results, where they differ from the input ---

SCORE_DISPLAY_NAMES: dict[str, str] = {
    "CEZ as": "CEZ, a.s.",
    "Électricité de France SA": "Electricité de France S.A.",
    "ENGIE SA": "Engie S.A.",
    "Iberdrola SA": "Iberdrola, S.A.",
    "National Grid Plc": "National Grid plc",
    "Ntpc Ltd.": f"NTPC Ltd.{NO_BREAK_SPACE}",
    "PGE Polska Grupa Energetyczna SA": "PGE Polska Grupa Energetyczna S.A.",
    "SSE Plc": "SSE plc",
    "Vistra Corp.": f"Vistra Corp.{NO_BREAK_SPACE}",
    "Xcel Energy, Inc.": "Xcel Energy Inc.",
    "Bayerische Motoren Werke AG": "BMW",
    "Ford Motor Co.": "Ford",
    "General Motors Co.": "General Motors",
    "Honda Motor Co., Ltd.": "Honda Motor",
    "Nissan Motor Co., Ltd.": "Nissan",
    "Peugeot Sa": "Peugeot SA",
    "Renault SA": "Renault",
    "SAIC Motor Corp. Ltd.": "Saic Motor",
    "Stellantis NV": "Stellantis (formerly Fiat/PSA Groupe)",
    "Suzuki Motor Corp.": "Suzuki Motor",
    "Toyota Motor Corp.": "Toyota",
    "Volkswagen AG": "Volkswagen",
    "Volvo Car AB": "Volvo",
    "Mercedes-Benz Group AG": "Mercedes-Benz (formerly Daimler AG)",
    "Constellation Energy Generation LLC": "Constellation Energy Corp.",
    "Berkshire Hathaway, Inc.": "Berkshire Hathaway Inc.",
    "Centrica Plc": "Centrica plc",
}

HDV_SCORE_DISPLAY_NAMES: dict[str, str] = {"Volvo AB": "Volvo"}

INTENSITY_DISPLAY_NAMES: dict[str, str] = {
    "ArcelorMittal SA": f"ArcelorMittal S.A.{NO_BREAK_SPACE}",
    "Bluescope Steel Ltd.": "BlueScope Steel Ltd.",
    "NIPPON STEEL CORP": "Nippon Steel Corp.",
    "NIPPON STEEL CORP.": "Nippon Steel Corp.",
    "POSCO": "POSCO Holdings Inc.",
    "Volvo Ab": "SSAB AB",
    "ThyssenKrupp AG": "thyssenkrupp AG",
    "Air France-KLM SA": f"Air France{EN_DASH}KLM S.A.",
    "ADBRI Ltd.": "Adbri Ltd.",
    "American Airlines Group, Inc.": "American Airlines Group Inc.",
    "Anhui Conch Cement Co., Ltd.": "Anhui Conch Cement Co. Ltd.",
    "CEMEX SAB de CV": "Cemex SAB de CV",
    "CRH Plc": "CRH plc",
    "Dangote Cement Plc": "Dangote Cement plc",
    "Grupo Argos SA": "Grupo Argos S.A.",
    "Holcim Ltd.": "Holcim Ltd",
}

# --- fixed values: technologies ------------------------------------------------

TECH_TYPES: dict[str, dict[str, str]] = {
    "Power": {
        "CoalCap": "Brown",
        "GasCap": "Brown",
        "HydroCap": "Green",
        "NuclearCap": "Green",
        "OilCap": "Brown",
        "RenewablesCap": "Green",
    },
    "Automotive": {"Electric": "Green", "Hybrid": "Green", "ICE": "Brown"},
    "HDV": {"Electric_HDV": "Green", "Hybrid_HDV": "Green", "ICE_HDV": "Brown"},
}

# Technologies a company can be rated on; a superset of the scored ones.
RATED_TECHS: dict[str, tuple[str, ...]] = {
    "Power": ("CoalCap", "GasCap", "HydroCap", "NuclearCap", "OilCap", "RenewablesCap"),
    "Automotive": ("Electric", "FuelCell", "Hybrid", "ICE"),
    "HDV": ("Electric_HDV", "FuelCell_HDV", "Hybrid_HDV", "ICE_HDV"),
}

SECTOR_KEYS = {"Automotive": "A"}
OTHER_SECTOR_KEY = "U"

# Technologies whose emission factor is 0 as soon as they produce.
ZERO_FACTOR_TECHS = ("Electric", "HydroCap", "NuclearCap", "RenewablesCap")

HDV_TECH_RECODE = {
    "ICE Propane_HDV": "ICE_HDV",
    "ICE CNG_HDV": "ICE_HDV",
    "ICE Gasoline_HDV": "ICE_HDV",
    "Hybrid No-Plug_HDV": "Hybrid_HDV",
    "ICE Hydrogen_HDV": "ICE_HDV",
    "ICE Diesel_HDV": "ICE_HDV",
}

DOUBLED_SUFFIX_RECODE = {
    "Electric_HDV_HDV": "Electric_HDV",
    "ICE_HDV_HDV": "ICE_HDV",
    "Hybrid_HDV_HDV": "Hybrid_HDV",
    "NA_HDV": "FuelCell_HDV",
}

PATHWAY_SCENARIOS = {"b2ds": "B2DS", "sds": "SDS", "rts": "NPS"}
PATHWAY_TECHS = {"electric": "Electric_HDV", "hybrid": "Hybrid_HDV", "ice": "ICE_HDV"}

# --- fixed values: emission intensity -------------------------------------------

INTENSITY_SECTORS = ("Steel", "Cement", "Aviation")
INTENSITY_EXCLUDED_TECHS = ("Grinding", "Freight")

# (scenario, sector, year, benchmark intensity)
INTENSITY_BENCHMARKS = (
    ("NZE_2050", "Cement", 2030, 0.44),
    ("NZE_2050", "Steel", 2030, 1.42),
    ("B2DS", "Aviation", 2030, 0.000059621956812),
)

# Sector -> gap above which a company is approaching / at moderate distance.
INTENSITY_BOUNDS = {"Aviation": (-0.15, -0.30), "Cement": (-0.05, -0.20), "Steel": (-0.15, -0.36)}

_NZE = "NZE (1.5°C)"
_B2DS = "B2DS (<2.0°C)"
INTENSITY_CLASSES = {
    "Aviation": (f"Approaching {_B2DS}", f"Moderate distance to {_B2DS}", f"Significant distance to {_B2DS}"),
    "Cement": (f"Approaching {_NZE}", f"Moderate distance {_NZE}", f"Significant distance {_NZE}"),
    "Steel": (f"Approaching {_NZE}", f"Moderate distance {_NZE}", f"Significant distance {_NZE}"),
}
INTENSITY_LIGHTS = ("Green", "Amber", "Red")

# --- fixed values: technology ratings --------------------------------------------

# Rating text and its traffic light; the position is the rating's code.
RATINGS: tuple[tuple[str | None, str | None], ...] = (
    (None, None),
    ("N.A.", None),
    ("Aligned with/Below NZE (<1.5°C)", "Green"),
    ("Aligned with APS (1.5°C - 1.7°C)", "Amber"),
    ("Above APS (>1.7°C)", "Red"),
    ("Aligned with /Above STEPS (>2.5°C)", "Red"),
    ("Aligned to B2DS <1.75°C", "Green"),
    ("Close to 2DS 1.75C-2°C", "Amber"),
    ("Above 2DS >2°C", "Red"),
    ("Significantly above 2DS >2.7°C", "Red"),
)

RATED_SCENARIOS = ("STEPS", "APS", "NZE_2050", "NPS", "SDS", "B2DS")

# --- fixed values: aggregate score -------------------------------------------------

# Sector -> (class when the score is at least 0, class otherwise).
SCORE_CLASSES = {
    "Power": ("Aligned with NZE  (1.5°C)", "Misaligned with NZE  (1.5°C)"),
    "Automotive": ("Aligned", "Misaligned"),
    "HDV": ("Aligned", "Misaligned"),
}
SCORE_LIGHTS = ("Green", "Red")

# --- fixed values: report sheets ----------------------------------------------------

NOT_ASSESSED = "Not Assessed"
NOT_APPLICABLE = "N.A."

REPORT_SHEETS = {
    "Power": "Electric Utilities",
    "Automotive": "Autos",
    "Cement": "Cement",
    "Steel": "Steel",
    "Aviation": "Aviation",
}
# Rows of the report template above the headings of each sheet.
TEMPLATE_SKIP = {"Electric Utilities": 12, "Autos": 5, "Cement": 5, "Steel": 5, "Aviation": 5}

# Sheet sector -> (internal column stem, heading stem, technology) in sheet order.
REPORT_TECHS = {
    "Power": (
        ("coal", "1.1 Coal", "1.1", "CoalCap"),
        ("oil", "1.3 Oil", "1.3", "OilCap"),
        ("gas", "1.2 Natural Gas", "1.2", "GasCap"),
        ("nuclear", "1.4 Nuclear", "1.4", "NuclearCap"),
        ("hydro", "1.5 Hydro", "1.5", "HydroCap"),
        ("renewables", "1.6 Renewables", "1.6", "RenewablesCap"),
    ),
    "Automotive": (
        ("ice", "1.1 ICE", "1.1", "ICE"),
        ("hybrid", "1.2 Hybrid", "1.2", "Hybrid"),
        ("electric", "1.3 EVs", "1.3", "Electric"),
    ),
}

OVERALL_HEADINGS = {
    "Power": "1. Capacity Alignment with 1.5°C - value",
    "Automotive": "1. Production Plan alignment with 1.5°C - value",
    "Cement": "1. - value",
    "Steel": "1. - value",
    "Aviation": "1. - value",
}
OVERALL_LIGHT_HEADING = "1. traffic light"

AUTOMOTIVE_NOT_REPORTED = ("Volvo AB",)

# Heading texts the steel and aviation sheets show in place of a missing value.
MISSING_LIGHT_TEXT = (
    f"2- 2DII  Alignment with the IEA{APOSTROPHE}s Beyond 2 Degrees Scenario target in 2030 - Traffic Light"
)
MISSING_VALUE_TEXT = f"2. 2DII Alignment with the IEA{APOSTROPHE}s Beyond 2 Degrees Scenario target in 2030"


# --- the same values as small tables ---------------------------------------------------


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def companies(spark: SparkSession) -> DataFrame:
    rows = [(name, sector) for sector, names in COMPANIES.items() for name in names]
    return spark.createDataFrame(rows, _strings("company_name", "sector_assessed"))


def tech_types(spark: SparkSession) -> DataFrame:
    rows = [(tech, sector, kind) for sector, techs in TECH_TYPES.items() for tech, kind in techs.items()]
    return spark.createDataFrame(rows, _strings("technology", "ald_sector", "type"))


def intensity_benchmarks(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("scenario", T.StringType()),
            T.StructField("ald_sector", T.StringType()),
            T.StructField("benchmark_year", T.IntegerType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(list(INTENSITY_BENCHMARKS), schema)


def tech_key(sector: str, technology: str) -> str:
    """Column key of a rated technology; dots come in only when a file is written."""
    return f"2di{SECTOR_KEYS.get(sector, OTHER_SECTOR_KEY)}2_{technology}T"
