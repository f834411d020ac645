"""The SQL each query is compared with, run by another engine on the same tables.

Written from the definition of each result, not from the Spark code: long
tables come from a grid of years, ladders are spelled out per sector, the
averaged rank counts rows instead of ranking them. All queries share one list
of common table expressions; an engine evaluates only those a query uses.
"""

from __future__ import annotations

from testbed import model
from pathgauge import refdata

P = model.PARAMS
T0, T1 = P.reference_year, P.end_year
YEARS = list(model.YEARS)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"({_text(a)}, {_text(b)})" for a, b in pairs.items())


def _nth(values, number: str) -> str:
    return f"{_list(values)}[1 + ({number}) % {len(values)}]"


SERIES = "company_id, company_name, sector, asset_country, technology, unit, emissions_factor"

_WIDE_SUMS = ", ".join(f"SUM(CASE WHEN y = {y} THEN net END) AS \"_{y}\"" for y in YEARS)

# Recoded names of a long row.
_CLEAN_TECH = """regexp_replace(CASE WHEN technology = 'Oil and Condensate' THEN 'Oil'
       WHEN sector = 'Coal' THEN 'Coal' ELSE technology END, 'Grade$', '')"""
_HDV_TECH = f"""CASE WHEN technology IN {_in(k for k, v in refdata.HDV_TECH_RECODE.items() if v == 'ICE_HDV')}
       THEN 'ICE_HDV' WHEN technology = 'Hybrid No-Plug_HDV' THEN 'Hybrid_HDV' ELSE technology END"""


def _zeroed(techs) -> str:
    return f"""SELECT * REPLACE (CASE
       WHEN technology NOT IN {_in(techs)} THEN emissions_factor
       WHEN ald_production IS NULL THEN NULL
       WHEN ald_production > 0 THEN 0.0 ELSE emissions_factor END AS emissions_factor)
     FROM long_rows"""


def _summed(source: str) -> str:
    return f"""SELECT company_name, company_id, sector, asset_country, technology, year, unit, emissions_factor,
       COALESCE(SUM(ald_production), 0) AS s
     FROM {source} GROUP BY ALL"""


def _merged(source: str, with_name: bool) -> str:
    name = "company_name, 'company_id' AS id_name," if with_name else ""
    return f"""SELECT id, {name} ald_sector, ald_location, technology, year, ald_production_unit,
       ald_emissions_factor, '-' AS ald_emissions_factor_unit,
       COALESCE(SUM(p), 0) AS ald_production
     FROM (SELECT company_id AS id, company_name, sector AS ald_sector, asset_country AS ald_location,
             {_CLEAN_TECH} AS technology, year, unit AS ald_production_unit,
             emissions_factor AS ald_emissions_factor, CASE WHEN s <= 0 THEN 0 ELSE s END AS p
           FROM {source}) GROUP BY ALL"""


def _ambition(scenario: str) -> str:
    up98, up01, down98, down01 = model.AMBITION[scenario]
    return f"""CASE WHEN technology IN {_in(model.GROWING)}
         THEN CASE year WHEN 1998 THEN {up98} WHEN 2001 THEN {up01} ELSE 1.0 END
         ELSE CASE year WHEN 1998 THEN {down98} WHEN 2001 THEN {down01} ELSE 1.0 END END"""


_WEO = " UNION ALL ".join(
    f"""SELECT 'WEO2022' AS source, '{s}' AS scenario, sector, technology, scenario_geography,
       'Production' AS indicator, CASE sector WHEN 'Power' THEN 'MW' ELSE '# vehicles' END AS units,
       year, CASE WHEN technology = 'HydroCap' AND year = 1998 THEN NULL
                  ELSE CAST(total * ({_ambition(s)}) AS DOUBLE) END AS value
     FROM placed_totals WHERE sector IN ('Power', 'Automotive')
       AND NOT (technology = 'NuclearCap' AND year = 1995)"""
    for s in model.AMBITION
)

_PATHWAY = " UNION ALL ".join(
    f"""SELECT '{s}' AS scenario, kind AS technology, year,
       CAST(total * (1.0 + (CASE kind WHEN 'ice' THEN -1.0 ELSE 1.0 END) * CAST({step} AS DOUBLE) * (year - 1995))
            AS DOUBLE) AS value
     FROM truck_totals"""
    for s, step in model.PATHWAY_STEP.items()
)

def _expected(source: str, own: str) -> str:
    """Expected production beside each plan of ``source``, from the first year's plans in ``own``."""
    return f"""SELECT p.id, p.equity_market, t.scenario_source, t.scenario, p.scenario_geography, p.ald_sector, p.technology,
    p.year, p.plan AS plan_tech_prod,
    COALESCE(a.p0, 0) + t.fair_share *
      CASE WHEN p.technology IN {_in(P.green_techs)} THEN COALESCE(b.s0, 0) ELSE COALESCE(a.p0, 0) END AS scen
  FROM {source} p JOIN targets_long t ON t.ald_sector = p.ald_sector AND t.technology = p.technology
    AND t.scenario_geography = p.scenario_geography AND t.year = p.year
  LEFT JOIN (SELECT id, scenario_geography, ald_sector, technology, plan AS p0 FROM {own} WHERE year = {T0}) a ON a.id = p.id AND a.scenario_geography = p.scenario_geography
    AND a.ald_sector = p.ald_sector AND a.technology = p.technology
  LEFT JOIN (SELECT id, scenario_geography, ald_sector, SUM(plan) AS s0 FROM {own} WHERE year = {T0} GROUP BY ALL) b ON b.id = p.id AND b.scenario_geography = p.scenario_geography
    AND b.ald_sector = p.ald_sector"""


_RATING = {rating: light for rating, light in refdata.RATINGS if rating}
_LIGHT = "CASE rating " + " ".join(
    f"WHEN {_text(r)} THEN {_text(light)}" for r, light in _RATING.items() if light
) + " END"
_R = [r for r, _ in refdata.RATINGS]
_NA, _NZE, _APS, _ABOVE, _STEPS, _H1, _H2, _H3, _H4 = (_text(r) for r in _R[1:])

_TECH_KEYS = [
    (refdata.tech_key(sector, tech), tech) for sector in refdata.RATED_TECHS for tech in refdata.RATED_TECHS[sector]
]
_WIDE_RATINGS = ", ".join(
    f"MAX(CASE WHEN technology = {_text(t)} THEN rating END) AS \"Rating_{k}\", "
    f"MAX(CASE WHEN technology = {_text(t)} THEN light END) AS \"traffic_light_{k}\""
    for k, t in _TECH_KEYS
)

_TYPES = " UNION ALL ".join(
    f"SELECT {_text(t)} AS technology, {_text(s)} AS ald_sector, {_text(k)} AS type"
    for s, techs in refdata.TECH_TYPES.items()
    for t, k in techs.items()
)

CTES = f"""
kinds AS (
  SELECT p_partkey, p_size, CAST(substr(p_brand, 7) AS INTEGER) AS n,
    CASE p_type WHEN 'ECONOMY' THEN 'Power' WHEN 'LARGE' THEN 'Automotive' WHEN 'MEDIUM' THEN 'HDV'
      WHEN 'SMALL' THEN 'Cement' WHEN 'STANDARD' THEN 'Aviation'
      WHEN 'PROMO' THEN CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) <= 13 THEN 'Steel'
        WHEN CAST(substr(p_brand, 7) AS INTEGER) <= 19 THEN 'Coal' ELSE 'Oil&Gas' END END AS sector
  FROM part),
assets AS (
  SELECT p_partkey, sector,
    CASE sector WHEN 'Power' THEN {_nth(model.POWER, 'n')} WHEN 'Automotive' THEN {_nth(model.AUTOMOTIVE, 'n')}
      WHEN 'HDV' THEN {_nth(model.HDV, 'n')} WHEN 'Steel' THEN {_nth(model.STEEL, 'n')}
      WHEN 'Coal' THEN {_nth(model.COAL, 'n')} WHEN 'Oil&Gas' THEN {_nth(model.OIL_GAS, 'n')}
      WHEN 'Cement' THEN {_nth(model.CEMENT, 'n')} ELSE {_nth(model.AVIATION, 'n')} END AS technology,
    CASE sector {' '.join(f"WHEN {_text(s)} THEN {_text(u)}" for s, u in model.UNITS.items())} END AS unit,
    CASE WHEN p_size <> {model.UNKNOWN_FACTOR_SIZE} THEN CAST(p_size AS DOUBLE) /
      CAST(CASE sector WHEN 'Steel' THEN 16 WHEN 'Aviation' THEN 524288 ELSE 64 END AS DOUBLE) END AS emissions_factor
  FROM kinds),
facts AS (
  SELECT l_suppkey AS company_id, s_name AS company_name, sector, n_name AS asset_country, r_name AS region,
    technology, unit, emissions_factor, CAST(year(l_shipdate) AS INTEGER) AS y, l_quantity AS gross,
    CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS net
  FROM lineitem JOIN assets ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
wide AS (SELECT {SERIES}, {_WIDE_SUMS} FROM facts GROUP BY {SERIES}),
series AS (SELECT DISTINCT {SERIES} FROM facts),
cells AS (SELECT {SERIES}, y, SUM(net) AS v FROM facts GROUP BY ALL),
long_rows AS (
  SELECT s.*, CAST(g.y AS INTEGER) AS year, c.v AS ald_production
  FROM series s CROSS JOIN (SELECT unnest(range(1995, 2002)) AS y) g
  LEFT JOIN cells c ON c.company_id = s.company_id AND c.company_name = s.company_name AND c.sector = s.sector
    AND c.asset_country = s.asset_country AND c.technology = s.technology AND c.unit = s.unit
    AND c.emissions_factor IS NOT DISTINCT FROM s.emissions_factor AND c.y = g.y),
zeroed_all AS ({_zeroed(refdata.ZERO_FACTOR_TECHS)}),
zeroed_run AS ({_zeroed(P.zero_emission_techs)}),
normal AS ({_merged('(' + _summed('zeroed_all') + ')', True)}),
master AS ({_merged('(' + _summed('zeroed_run') + ')', False)}),
listed AS (
  SELECT s_name AS company_name, s_nationkey AS k, s_acctbal AS b, s_suppkey FROM supplier WHERE s_acctbal >= 0),
assessed AS (
  SELECT company_name, {_nth(model.ASSESSED, 'k')} AS sector_assessed FROM listed
  UNION ALL SELECT company_name, {_nth(model.ASSESSED, 'k + 1')} FROM listed WHERE b >= {model.TWO_SECTOR_BALANCE}),
bridge AS (
  SELECT DISTINCT w.company_name, w.company_id, a.sector_assessed
  FROM wide w JOIN assessed a ON a.company_name = w.company_name),
geographies AS (
  SELECT n_name AS country, 'Global' AS scenario_geography FROM nation
  UNION ALL SELECT n_name, CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'OECD' ELSE 'NonOECD' END
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
geo_names AS (SELECT * FROM (VALUES {', '.join(f"({_text(a)}, {_text(b)}, {_text(c)})" for a, b, c in model.BRIDGE)})
  AS t(source, geo_source, geo_model)),
placed_totals AS (
  SELECT sector, technology, scenario_geography, y AS year, SUM(gross) AS total
  FROM (SELECT sector, technology, y, gross, 'World' AS scenario_geography FROM facts
        UNION ALL SELECT sector, technology, y, gross,
          CASE WHEN region IN ('AMERICA', 'EUROPE') THEN 'Advanced economies' ELSE 'Emerging economies' END
        FROM facts)
  WHERE y IN (1995, 1998, 2001) GROUP BY ALL),
weo AS ({_WEO}),
raw_scenarios AS (
  SELECT * FROM weo
  UNION ALL SELECT 'GECO2021', scenario, sector,
    CASE technology WHEN 'Electric' THEN 'Electric_HDV_HDV' WHEN 'Hybrid' THEN 'Hybrid_HDV_HDV'
      WHEN 'ICE' THEN 'ICE_HDV_HDV' WHEN 'FuelCell' THEN 'NA_HDV' ELSE technology END, scenario_geography, indicator,
    units, year, value * 1.5
  FROM weo WHERE scenario = 'NZE_2050' AND scenario_geography = 'World'
  UNION ALL SELECT 'SECTOR2021', 'REF', sector, technology, scenario_geography, NULL, 't', year, total
  FROM placed_totals WHERE sector IN ('Steel', 'Cement') AND scenario_geography = 'World' AND year IN (1995, 2001)),
spans AS (
  SELECT source, scenario, sector, technology, scenario_geography, indicator, units,
    MIN(year) AS lo, MAX(year) AS hi FROM raw_scenarios GROUP BY ALL),
span_years AS (SELECT * EXCLUDE (lo, hi), CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS year FROM spans),
around AS (
  SELECT g.*,
    (SELECT MAX(r.year) FROM raw_scenarios r WHERE r.value IS NOT NULL AND r.year <= g.year AND r.source = g.source
      AND r.scenario = g.scenario AND r.technology = g.technology AND r.sector = g.sector
      AND r.scenario_geography = g.scenario_geography) AS y0,
    (SELECT MIN(r.year) FROM raw_scenarios r WHERE r.value IS NOT NULL AND r.year >= g.year AND r.source = g.source
      AND r.scenario = g.scenario AND r.technology = g.technology AND r.sector = g.sector
      AND r.scenario_geography = g.scenario_geography) AS y1
  FROM span_years g),
yearly AS (
  SELECT a.source, a.scenario, a.sector, a.technology, a.scenario_geography, a.indicator, a.units, a.year,
    CASE WHEN a.y0 = a.y1 THEN r0.value
      ELSE r0.value + (r1.value - r0.value) * (a.year - a.y0) / (a.y1 - a.y0) END AS value
  FROM around a
  LEFT JOIN raw_scenarios r0 ON r0.source = a.source AND r0.scenario = a.scenario AND r0.sector = a.sector
    AND r0.technology = a.technology AND r0.scenario_geography = a.scenario_geography AND r0.year = a.y0
  LEFT JOIN raw_scenarios r1 ON r1.source = a.source AND r1.scenario = a.scenario AND r1.sector = a.sector
    AND r1.technology = a.technology AND r1.scenario_geography = a.scenario_geography AND r1.year = a.y1),
truck_totals AS (
  SELECT CASE technology {' '.join(f"WHEN {_text(t)} THEN {_text(k)}" for t, k in model.PATHWAY_KIND.items())} END
    AS kind, y AS year, SUM(gross) AS total
  FROM facts WHERE sector = 'HDV' GROUP BY ALL),
truck_path AS ({_PATHWAY}),
trucks AS (
  SELECT 'ETP2017' AS source,
    CASE scenario WHEN 'b2ds' THEN 'B2DS' WHEN 'sds' THEN 'SDS' WHEN 'rts' THEN 'NPS' END AS scenario,
    'HDV' AS sector,
    CASE technology WHEN 'electric' THEN 'Electric_HDV' WHEN 'hybrid' THEN 'Hybrid_HDV' WHEN 'ice' THEN 'ICE_HDV' END
      AS technology,
    'Global' AS scenario_geography, '#' AS indicator, '#' AS units, year, value
  FROM truck_path WHERE year >= {T0}),
all_paths AS (
  SELECT * FROM yearly WHERE year >= {T0} UNION ALL SELECT * FROM trucks),
starts AS (
  SELECT source, scenario, scenario_geography, sector, technology, MAX(value) AS v0
  FROM all_paths WHERE year = {T0} GROUP BY ALL),
sector_starts AS (
  SELECT source, scenario, scenario_geography, sector, SUM(value) AS s0 FROM all_paths WHERE year = {T0} GROUP BY ALL),
shares AS (
  SELECT p.source AS scenario_source, p.scenario, p.sector AS ald_sector, p.technology, p.scenario_geography,
    p.indicator, p.units, p.year, p.value, p.value / NULLIF(a.v0, 0) AS tmsr,
    (p.value - a.v0) / NULLIF(b.s0, 0) AS smsp
  FROM all_paths p
  LEFT JOIN starts a ON a.source = p.source AND a.scenario = p.scenario AND a.sector = p.sector
    AND a.scenario_geography = p.scenario_geography AND a.technology IS NOT DISTINCT FROM p.technology
  LEFT JOIN sector_starts b ON b.source = p.source AND b.scenario = p.scenario AND b.sector = p.sector
    AND b.scenario_geography = p.scenario_geography),
targets AS (
  SELECT *, CASE WHEN technology IN {_in(P.green_techs)} THEN smsp ELSE tmsr - 1 END AS fair_share FROM shares),
targets_long AS (
  SELECT DISTINCT scenario_source, scenario,
    CASE WHEN technology IN ('Electric_HDV_HDV', 'ICE_HDV_HDV', 'Hybrid_HDV_HDV', 'NA_HDV') THEN 'HDV'
      ELSE ald_sector END AS ald_sector,
    CASE WHEN ald_sector = 'HDV' AND technology IS NULL OR technology = 'NA_HDV' THEN 'FuelCell_HDV'
      WHEN technology LIKE '%_HDV_HDV' THEN replace(technology, '_HDV_HDV', '_HDV') ELSE technology END AS technology,
    scenario_geography, indicator, units, year, value, tmsr, smsp, fair_share
  FROM (
    SELECT t.* REPLACE (g.geo_model AS scenario_geography)
    FROM targets t JOIN geo_names g ON g.source = t.scenario_source AND g.geo_source = t.scenario_geography
    WHERE t.scenario_source IN {_in(P.scenario_sources)} AND t.ald_sector IN {_in(P.all_sectors)}
      AND g.geo_model IN (SELECT scenario_geography FROM geographies) AND t.year BETWEEN {T0} AND {T1}
    UNION ALL SELECT * FROM targets WHERE scenario_source = 'ETP2017')),
scoped AS (
  SELECT id, ald_location, ald_sector, {_HDV_TECH} AS technology, year, ald_production
  FROM master WHERE id IN (SELECT company_id FROM bridge) AND year BETWEEN {T0} AND {T1}
    AND ald_sector IN {_in(P.all_sectors)}),
plans AS (
  SELECT id, 'GlobalMarket' AS equity_market, g.scenario_geography, ald_sector, technology, year,
    SUM(ald_production) AS plan
  FROM scoped JOIN geographies g ON g.country = ald_location
  WHERE g.scenario_geography IN {_in(P.scenario_geographies)} AND technology NOT IN {_in(P.excluded_techs)}
  GROUP BY ALL),
plans_sparse AS (SELECT * FROM plans WHERE (id + length(technology)) % 3 <> 0),
plans_complete AS (
  SELECT * FROM plans_sparse
  UNION ALL SELECT c.id, 'GlobalMarket', c.scenario_geography, c.ald_sector, t.technology, CAST(y.year AS INTEGER), 0.0
  FROM (SELECT DISTINCT id, scenario_geography, ald_sector FROM plans_sparse) c
  JOIN (SELECT DISTINCT ald_sector, technology FROM targets_long
        WHERE technology IS NOT NULL AND technology NOT IN {_in(P.excluded_techs)}) t ON t.ald_sector = c.ald_sector
  CROSS JOIN (SELECT unnest(range({T0}, {T1 + 1})) AS year) y
  WHERE NOT EXISTS (SELECT 1 FROM plans_sparse p WHERE p.id = c.id AND p.scenario_geography = c.scenario_geography
    AND p.ald_sector = c.ald_sector AND p.technology = t.technology)),
expected AS ({_expected('plans', 'plans')}),
connected AS (
  SELECT * EXCLUDE (scen), CASE WHEN scen <= 0 THEN 0 ELSE scen END AS scen_tech_prod FROM expected),
connected_complete AS (
  SELECT * EXCLUDE (scen), CASE WHEN scen <= 0 THEN 0 ELSE scen END AS scen_tech_prod
  FROM ({_expected('plans_complete', 'plans_sparse')})),
assessed_rows AS (SELECT * FROM connected WHERE scenario_source IN ('WEO2022', 'ETP2017')),
ei_rows AS (
  SELECT m.*, b.company_name FROM master m JOIN bridge b ON b.company_id = m.id
  WHERE m.ald_sector IN ('Steel', 'Cement', 'Aviation') AND m.technology NOT IN ('Grinding', 'Freight')
    AND m.year = {T0}),
ei AS (
  SELECT company_name, year, ald_sector,
    CASE WHEN SUM(CASE WHEN ald_production <> 0 AND ald_emissions_factor IS NULL THEN 1 ELSE 0 END) = 0
      THEN SUM(CASE WHEN ald_production <> 0 THEN ald_emissions_factor * ald_production END)
           / NULLIF(SUM(ald_production), 0) END AS emission_intensity_sector
  FROM ei_rows GROUP BY ALL),
ei_targets AS (SELECT * FROM (VALUES {', '.join(f"({_text(s)}, {_text(x)}, {y}, CAST({v} AS DOUBLE))" for s, x, y, v in refdata.INTENSITY_BENCHMARKS)})
  AS t(scenario, ald_sector, benchmark_year, value)),
ei_gap AS (
  SELECT e.*, t.scenario, t.benchmark_year, t.value,
    CASE WHEN emission_intensity_sector = 0 AND value > 0 THEN CAST('inf' AS DOUBLE)
      ELSE (value - emission_intensity_sector) / NULLIF(emission_intensity_sector, 0) END AS gap
  FROM ei e JOIN ei_targets t ON t.ald_sector = e.ald_sector),
ei_class AS (
  SELECT *, CASE ald_sector
      WHEN 'Aviation' THEN CASE WHEN gap > -0.15 THEN 'Approaching B2DS (<2.0°C)'
        WHEN gap > -0.30 THEN 'Moderate distance to B2DS (<2.0°C)' ELSE 'Significant distance to B2DS (<2.0°C)' END
      WHEN 'Cement' THEN CASE WHEN gap > -0.05 THEN 'Approaching NZE (1.5°C)'
        WHEN gap > -0.20 THEN 'Moderate distance NZE (1.5°C)' ELSE 'Significant distance NZE (1.5°C)' END
      ELSE CASE WHEN gap > -0.15 THEN 'Approaching NZE (1.5°C)'
        WHEN gap > -0.36 THEN 'Moderate distance NZE (1.5°C)' ELSE 'Significant distance NZE (1.5°C)' END
    END AS alignement_classement
  FROM ei_gap),
ei_result AS (
  SELECT *, CASE WHEN alignement_classement LIKE 'Approaching%' THEN 'Green'
      WHEN alignement_classement LIKE 'Moderate%' THEN 'Amber' ELSE 'Red' END AS traffic_light
  FROM ei_class),
ladder AS (
  SELECT id, ald_sector, technology, plan_tech_prod AS plan,
    MAX(CASE WHEN scenario = 'STEPS' THEN scen_tech_prod END) AS "STEPS",
    MAX(CASE WHEN scenario = 'APS' THEN scen_tech_prod END) AS "APS",
    MAX(CASE WHEN scenario = 'NZE_2050' THEN scen_tech_prod END) AS "NZE_2050",
    MAX(CASE WHEN scenario = 'NPS' THEN scen_tech_prod END) AS "NPS",
    MAX(CASE WHEN scenario = 'SDS' THEN scen_tech_prod END) AS "SDS",
    MAX(CASE WHEN scenario = 'B2DS' THEN scen_tech_prod END) AS "B2DS",
    CASE WHEN technology IN {_in(P.brown_techs)} THEN 'Brown' ELSE 'Green' END AS category
  FROM assessed_rows
  WHERE year = {T1} AND scenario_geography = 'Global' AND ald_sector IN ('Power', 'Automotive', 'HDV')
  GROUP BY ALL),
ladder2 AS (
  SELECT * REPLACE (CASE WHEN ald_sector = 'Power' AND category = 'Green' AND "NZE_2050" <= "APS" THEN "APS"
      WHEN ald_sector = 'Power' AND category = 'Brown' AND "NZE_2050" >= "APS" THEN "APS"
      ELSE "NZE_2050" END AS "NZE_2050") FROM ladder),
ratings AS (
  SELECT *, CASE
    WHEN ald_sector = 'Power' AND category = 'Green' THEN CASE WHEN plan = 0 THEN {_NA}
      WHEN plan >= "STEPS" AND plan < "APS" THEN {_ABOVE} WHEN plan >= "APS" AND plan < "NZE_2050" THEN {_APS}
      WHEN plan >= "NZE_2050" THEN {_NZE} ELSE {_STEPS} END
    WHEN ald_sector = 'Power' THEN CASE WHEN plan > "STEPS" THEN {_STEPS}
      WHEN plan > "APS" AND plan < "STEPS" THEN {_ABOVE} WHEN plan > "NZE_2050" AND plan < "APS" THEN {_APS}
      WHEN plan = 0 AND "NZE_2050" = 0 THEN {_NA} ELSE {_NZE} END
    WHEN ald_sector = 'Automotive' AND category = 'Green' THEN CASE WHEN plan = 0 THEN {_NA}
      WHEN plan >= "NZE_2050" THEN {_NZE} WHEN plan >= "APS" THEN {_APS} ELSE {_ABOVE} END
    WHEN ald_sector = 'Automotive' THEN CASE WHEN plan = 0 THEN {_NA}
      WHEN plan <= "NZE_2050" THEN {_NZE} WHEN plan <= "APS" THEN {_APS} ELSE {_ABOVE} END
    WHEN category = 'Brown' THEN CASE WHEN plan >= "NPS" THEN {_H4} WHEN plan >= "SDS" AND plan < "NPS" THEN {_H3}
      WHEN plan >= "B2DS" AND plan < "SDS" THEN {_H2} WHEN plan < "B2DS" THEN {_H1} WHEN plan = 0 THEN {_NA} END
    ELSE CASE WHEN plan = 0 THEN {_NA} WHEN plan < "NPS" THEN {_H4} WHEN plan >= "NPS" AND plan < "SDS" THEN {_H3}
      WHEN plan >= "SDS" AND plan < "B2DS" THEN {_H2} WHEN plan >= "B2DS" THEN {_H1} END
    END AS rating FROM ladder2),
lights AS (SELECT *, {_LIGHT} AS light FROM ratings),
tech_wide AS (
  SELECT company_name, ald_sector, {_WIDE_RATINGS}
  FROM lights JOIN bridge ON company_id = id AND sector_assessed = ald_sector GROUP BY company_name, ald_sector),
types AS ({_TYPES}),
sums AS (
  SELECT company_name, id, scenario_source, scenario, scenario_geography, ald_sector, technology, year,
    COALESCE(SUM(plan_tech_prod), 0) AS plan_tech_prod, COALESCE(SUM(scen_tech_prod), 0) AS scen_tech_prod
  FROM assessed_rows JOIN bridge ON company_id = id
  WHERE year IN ({T0}, {T1}) AND ald_sector IN ('Power', 'Automotive', 'HDV') GROUP BY ALL),
sector_sums AS (
  SELECT company_name, id, scenario, scenario_geography, ald_sector, year,
    SUM(plan_tech_prod) AS plan_sec_prod, SUM(scen_tech_prod) AS scen_sec_prod FROM sums GROUP BY ALL),
tech_shares AS (
  SELECT s.*, t.plan_sec_prod, t.scen_sec_prod, s.plan_tech_prod / NULLIF(t.plan_sec_prod, 0) AS plan_tech_share,
    s.scen_tech_prod / NULLIF(t.scen_sec_prod, 0) AS scen_tech_share
  FROM sums s JOIN sector_sums t ON t.company_name = s.company_name AND t.id = s.id AND t.scenario = s.scenario
    AND t.scenario_geography = s.scenario_geography AND t.ald_sector = s.ald_sector AND t.year = s.year),
edges AS (
  SELECT *, FIRST_VALUE(scen_tech_prod) OVER w AS scen_first, LAST_VALUE(scen_tech_prod) OVER w AS scen_last,
    LAST_VALUE(plan_tech_prod) OVER w AS plan_last
  FROM tech_shares
  WINDOW w AS (PARTITION BY company_name, id, scenario_source, scenario, scenario_geography, ald_sector, technology
               ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
weights AS (
  SELECT e.*, y.type, ABS(plan_last - scen_first) AS production_change,
    CASE WHEN e.technology IN {_in(P.most_relevant_techs)}
           AND ABS(plan_last - scen_first) > ABS(scen_last - scen_first)
      THEN ABS(plan_last - scen_first) ELSE ABS(scen_last - scen_first) END AS scenario_change,
    CASE WHEN e.technology IN {_in(P.most_relevant_techs)} AND plan_last > scen_last
      THEN plan_last ELSE scen_last END AS tech_allocation_weight,
    CASE WHEN y.type = 'Green' THEN 1.0 ELSE -1.0 END *
      CASE WHEN scen_tech_prod = 0 THEN CASE WHEN plan_tech_prod = 0 THEN 0.0 ELSE 1.0 END
        ELSE (plan_tech_prod - scen_tech_prod) / scen_tech_prod END AS trajectory_alignment
  FROM edges e JOIN types y ON y.technology = e.technology AND y.ald_sector = e.ald_sector
  WHERE scenario_geography = 'Global'),
factors AS (SELECT *, scenario_change * tech_allocation_weight AS weighting_factor FROM weights),
scores AS (
  SELECT company_name, id, scenario_source, scenario, scenario_geography, ald_sector, year,
    SUM(trajectory_alignment * weighting_factor) / NULLIF(SUM(weighting_factor), 0) AS score,
    COUNT(*) AS n_technologies
  FROM factors GROUP BY ALL),
picked AS (
  SELECT DISTINCT ald_sector, company_name, score FROM scores
  WHERE year = {T1} AND ((ald_sector <> 'HDV' AND (scenario_source, scenario) = ('WEO2022', 'NZE_2050'))
    OR (scenario_source, scenario) = ('ETP2017', 'B2DS') AND company_name IN {_in(model.HDV_SCORED)})),
ranked AS (
  SELECT p.ald_sector, p.company_name, p.score AS "single_score_Case8",
    CASE WHEN p.score IS NOT NULL THEN CAST(
      (SELECT COUNT(*) FROM picked q WHERE q.ald_sector = p.ald_sector AND (q.score IS NULL OR q.score > p.score))
      + ((SELECT COUNT(*) FROM picked q WHERE q.ald_sector = p.ald_sector AND q.score = p.score) + 1) / 2.0
      AS DOUBLE) END AS rank,
    CASE WHEN p.ald_sector = 'Power'
      THEN CASE WHEN p.score >= 0 THEN 'Aligned with NZE  (1.5°C)' ELSE 'Misaligned with NZE  (1.5°C)' END
      ELSE CASE WHEN p.score >= 0 THEN 'Aligned' ELSE 'Misaligned' END END AS aggregate_score_class,
    CASE WHEN p.score >= 0 THEN 'Green' ELSE 'Red' END AS aggregate_score_traffic_light
  FROM picked p),
comm AS (
  SELECT f.*, s.score FROM factors f JOIN scores s ON s.company_name = f.company_name AND s.id = f.id
    AND s.scenario_source = f.scenario_source AND s.scenario = f.scenario AND s.ald_sector = f.ald_sector
    AND s.year = f.year),
comm_wide AS (
  SELECT technology, ald_sector, company_name, scenario, scenario_geography,
    {', '.join(f"MAX(CASE WHEN year = {y} THEN {s}_tech_prod END) AS {s}_tech_prod_{y}" for y in (T0, T1) for s in ('plan', 'scen'))}
  FROM factors GROUP BY ALL),
comm_end AS (
  SELECT *, weighting_factor / NULLIF(SUM(weighting_factor)
    OVER (PARTITION BY ald_sector, company_name, scenario, scenario_geography), 0) AS weight_share
  FROM comm WHERE year = {T1}),
truck_maker AS (
  SELECT arg_min(company_name, company_id) AS maker, MIN(company_id) AS maker_id FROM (
    SELECT company_id, company_name FROM bridge WHERE sector_assessed IN ('Automotive', 'HDV')
    GROUP BY ALL HAVING COUNT(DISTINCT sector_assessed) = 2)),
rosters AS (
  SELECT s_name AS "Company", sector FROM (
    SELECT s_name, {_nth(model.ASSESSED, 's_nationkey')} AS sector FROM supplier
    UNION ALL SELECT s_name, {_nth(model.ASSESSED, 's_nationkey + 1')} FROM supplier
      WHERE s_acctbal >= {model.TWO_SECTOR_BALANCE})),
stand_ins AS (
  SELECT {_nth([n for g in refdata.COMPANIES.values() for n in g], 'l_suppkey')} AS company_name,
    SUM(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
"""


def _q(body: str) -> str:
    return f"WITH {CTES}\n{body}"


def _r(*columns: str) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in columns)


_SHARED = "scenario_source, scenario, ald_sector, technology, scenario_geography, indicator, units, year"
_FACT = (
    "id, ald_sector, ald_location, technology, year, ald_production_unit, ald_emissions_factor, "
    "ald_emissions_factor_unit, ald_production"
)


def _sector_ratings(sector: str, names: tuple[str, ...]) -> str:
    quoted = ", ".join(f'ROUND("{n}", 6) AS "{n}"' for n in names)
    return _q(
        f"""SELECT id, ald_sector, technology, category, plan AS plan_tech_prod, {quoted},
        rating AS "Scen_Rating", light AS traffic_light FROM lights WHERE ald_sector = '{sector}'"""
    )


def _tech_report(sector: str, with_truck_maker: bool = False) -> str:
    cells = []
    for stem, _, _, tech in refdata.REPORT_TECHS[sector]:
        key = refdata.tech_key(sector, tech)
        for kind, suffix in (("Rating", "value"), ("traffic_light", "light")):
            cells.append(f"COALESCE(NULLIF(t.\"{kind}_{key}\", 'N.A.'), 'Not Assessed') AS {stem}_{suffix}")
    company, left_out, maker = 'r."Company"', "", ""
    if with_truck_maker:
        company = """CASE WHEN r."Company" = maker THEN 'Volvo AB' ELSE r."Company" END AS "Company\""""
        left_out, maker = "AND t.company_name IS DISTINCT FROM maker", "CROSS JOIN truck_maker"
    return _q(
        f"""SELECT {company}, COALESCE(k.aggregate_score_class, 'Not Assessed') AS overall_value,
        COALESCE(k.aggregate_score_traffic_light, 'Not Assessed') AS overall_light, {', '.join(cells)}
        FROM rosters r {maker}
        LEFT JOIN ranked k ON k.company_name = r."Company" AND k.ald_sector = '{sector}'
        LEFT JOIN tech_wide t ON t.company_name = r."Company" AND t.ald_sector = '{sector}' {left_out}
        WHERE r.sector = '{sector}'"""
    )


def _nearest(units: str) -> str:
    """The double nearest to a whole number of 2 ** -60: both parts of the one addition are exact."""
    half = 2**50
    return f"((CAST({units} // {half} AS DOUBLE) * {half}.0 + CAST({units} % {half} AS DOUBLE)) / {2.0**60})"


ORACLES: dict[str, str] = {
    "scan_wide": _q("SELECT * FROM wide"),
    "production_csv": _q("SELECT * FROM wide"),
    "csv_rejects": _q(
        """SELECT company_name, sector, asset_country, technology, unit, 'emissions_factor' AS field, 'unknown' AS text
        FROM wide WHERE emissions_factor IS NOT NULL AND company_id % 5 = 0 UNION ALL """
        + " UNION ALL ".join(
            f"""SELECT company_name, sector, asset_country, technology, unit, '_{y}', 'n/a {y}' FROM wide
            WHERE "_{y}" IS NOT NULL AND (company_id + {y}) % 7 = 0"""
            for y in YEARS
        )
    ),
    "unpivot_years": _q("SELECT * FROM long_rows"),
    "zero_emission": _q("SELECT * FROM zeroed_all"),
    "prod_normalise": _q("SELECT * FROM normal"),
    "masterdata": _q("SELECT * FROM master"),
    "hdv_recode": _q(
        f"""SELECT id, ald_sector, {_HDV_TECH} AS technology, year, SUM(ald_production) AS ald_production
        FROM master GROUP BY ALL"""
    ),
    "hdv_pathway": _q("SELECT * FROM trucks"),
    "scenario_union": _q("SELECT * FROM raw_scenarios"),
    "interpolate": _q("SELECT * REPLACE (ROUND(value, 6) AS value) FROM yearly"),
    "market_share": _q(f"SELECT {_SHARED}, {_r('value', 'tmsr', 'smsp', 'fair_share')} FROM targets"),
    "geo_bridge_join": _q(
        """SELECT r.source AS scenario_source, scenario, sector, technology, g.geo_model AS scenario_geography,
        indicator, units, year, value
        FROM raw_scenarios r JOIN geo_names g ON g.source = r.source AND g.geo_source = r.scenario_geography"""
    ),
    "index_regions": _q(
        "SELECT DISTINCT asset_country AS country_iso, 'GlobalMarket' AS equity_market FROM wide"
    ),
    "scenario_long": _q(f"SELECT {_SHARED}, {_r('value', 'tmsr', 'smsp', 'fair_share')} FROM targets_long"),
    "company_scope": _q(
        f"SELECT {_FACT} FROM master m WHERE EXISTS (SELECT 1 FROM bridge b WHERE b.company_id = m.id)"
    ),
    "scope_layout": _q(f"SELECT {_FACT} FROM master m WHERE m.id IN (SELECT company_id FROM bridge)"),
    "name_bridge": _q("SELECT * FROM bridge"),
    "bridge_join": _q(
        f"""SELECT {_FACT}, company_name, sector_assessed
        FROM master LEFT JOIN bridge ON company_id = id WHERE year = {T0}"""
    ),
    "connect": _q("SELECT * REPLACE (ROUND(scen_tech_prod, 6) AS scen_tech_prod) FROM connected"),
    "connect_complete": _q("SELECT * REPLACE (ROUND(scen_tech_prod, 6) AS scen_tech_prod) FROM connected_complete"),
    "exact_sums": f"""
        WITH v AS (
          SELECT l_suppkey, l_returnflag, l_extendedprice * (1 - l_discount) AS w, l_discount AS x FROM lineitem),
        s AS (
          SELECT l_suppkey, l_returnflag, SUM(CAST(w * {2.0**60} AS HUGEINT)) AS w, SUM(CAST(x * w * {2.0**60} AS HUGEINT)) AS xw
          FROM v GROUP BY ALL)
        SELECT l_suppkey, l_returnflag, {_nearest("w")} AS revenue, {_nearest("xw")} / {_nearest("w")} AS mean_discount
        FROM s""",
    "global_aggregate": _q(
        """SELECT id, equity_market, v.name AS scenario_source, scenario, scenario_geography, ald_sector, technology,
          year, plan_tech_prod, ROUND(scen_tech_prod, 6) AS scen_tech_prod
        FROM connected JOIN (VALUES ('ALL', 'OECD'), ('ALL', 'NonOECD'), ('TOP', 'Global'), ('SOME', 'Global'),
          ('SOME', 'OECD')) AS v(name, place) ON v.place = scenario_geography
        WHERE scenario_source = 'WEO2022' AND ald_sector = 'Power'
        UNION ALL SELECT id, equity_market, 'ALL', scenario, 'Global', ald_sector, technology, year,
          SUM(plan_tech_prod), ROUND(SUM(scen_tech_prod), 6)
        FROM connected WHERE scenario_source = 'WEO2022' AND ald_sector = 'Power'
          AND scenario_geography IN ('OECD', 'NonOECD')
        GROUP BY id, equity_market, scenario, ald_sector, technology, year"""
    ),
    "result_csv": _q(
        'SELECT * REPLACE (ROUND("single_score_Case8", 6) AS "single_score_Case8") FROM ranked'
    ),
    "per_source_output": _q(
        """SELECT scenario_source, scenario, COUNT(*) AS n_rows, SUM(plan_tech_prod) AS plan_tech_prod
        FROM connected GROUP BY ALL"""
    ),
    "stage_roundtrip": _q("SELECT * FROM master"),
    "csv_roundtrip": _q(f"SELECT {_SHARED}, {_r('value', 'tmsr', 'smsp', 'fair_share')} FROM targets"),
    "ei_benchmark": _q(
        f"""SELECT m.ald_sector, scenario, benchmark_year, value, m.ald_production,
        ROUND(m.ald_production * value, 6) AS allowed
        FROM (SELECT ald_sector, SUM(ald_production) AS ald_production FROM master WHERE year = {T0} GROUP BY ALL) m
        JOIN ei_targets t ON t.ald_sector = m.ald_sector"""
    ),
    "tech_type_dim": _q(
        f"""SELECT m.ald_sector, type, year, SUM(ald_production) AS ald_production
        FROM (SELECT ald_sector, {_HDV_TECH} AS technology, year, ald_production FROM master) m
        JOIN types t ON t.ald_sector = m.ald_sector AND t.technology = m.technology GROUP BY ALL"""
    ),
    "ei_scope": _q(
        f"""SELECT {_FACT} FROM master WHERE ald_sector IN ('Steel', 'Cement', 'Aviation')
        AND technology <> 'Grinding' AND technology <> 'Freight' AND year = {T0}"""
    ),
    "ei_intensity": _q(
        "SELECT company_name, year, ald_sector, emission_intensity_sector FROM ei"
    ),
    "ei_score": _q(
        """SELECT ald_sector, company_name, year, emission_intensity_sector, value, scenario,
        benchmark_year, gap AS alignment_metric, alignement_classement, traffic_light FROM ei_result"""
    ),
    "traj_base": _q(
        f"""SELECT id, ald_sector, technology, plan, category,
        {', '.join(f'ROUND("{n}", 6) AS "{n}"' for n in refdata.RATED_SCENARIOS)} FROM ladder"""
    ),
    "traj_power": _sector_ratings("Power", ("STEPS", "APS", "NZE_2050")),
    "traj_auto": _sector_ratings("Automotive", ("STEPS", "APS", "NZE_2050")),
    "traj_hdv": _sector_ratings("HDV", ("NPS", "SDS", "B2DS")),
    "traj_wide": _q("SELECT * FROM tech_wide"),
    "display_names": _q(
        f"""SELECT company_name, COALESCE(a.b, company_name) AS score_name, COALESCE(i.b, company_name) AS intensity_name,
        SUM(quantity) AS quantity
        FROM stand_ins
        LEFT JOIN (VALUES {_values(refdata.SCORE_DISPLAY_NAMES)}) AS a(a, b) ON a.a = company_name
        LEFT JOIN (VALUES {_values(refdata.INTENSITY_DISPLAY_NAMES)}) AS i(a, b) ON i.a = company_name
        GROUP BY ALL"""
    ),
    "tech_share": _q(
        f"""SELECT company_name, id, scenario_source, scenario, scenario_geography, ald_sector, technology, year,
        plan_tech_prod, plan_sec_prod, {_r('scen_tech_prod', 'scen_sec_prod', 'plan_tech_share', 'scen_tech_share')}
        FROM tech_shares"""
    ),
    "agg_factors": _q(
        f"""SELECT company_name, id, scenario_source, scenario, ald_sector, technology, year, type,
        {_r('scenario_change', 'production_change', 'tech_allocation_weight', 'trajectory_alignment')} FROM factors"""
    ),
    "agg_score": _q(
        """SELECT company_name, id, scenario_source, scenario, ald_sector, year,
        ROUND(score, 6) AS "single_score_Case8", n_technologies FROM scores"""
    ),
    "truck_names": _q(
        f"""SELECT DISTINCT ald_sector, CASE WHEN id = maker_id AND ald_sector = 'HDV' THEN 'Volvo'
          WHEN id = maker_id THEN 'Volvo AB' ELSE company_name END AS company_name,
          ROUND(score, 6) AS "single_score_Case8"
        FROM scores CROSS JOIN truck_maker
        WHERE year = {T1} AND ((ald_sector <> 'HDV' AND (scenario_source, scenario) = ('WEO2022', 'NZE_2050'))
          OR (scenario_source, scenario) = ('ETP2017', 'B2DS')
            AND (id = maker_id OR company_name IN {_in(model.HDV_SCORED)}))"""
    ),
    "placed_score": _q('SELECT ald_sector, company_name, ROUND("single_score_Case8", 6) AS "single_score_Case8" FROM ranked'),
    "agg_rank": _q(
        'SELECT * REPLACE (ROUND("single_score_Case8", 6) AS "single_score_Case8") FROM ranked'
    ),
    "comm_values_long": _q(
        """SELECT technology, ald_sector, company_name, scenario, scenario_geography,
        'plan_tech_prod_' || year AS metric, ROUND(plan_tech_prod, 6) AS value FROM factors
        UNION ALL SELECT technology, ald_sector, company_name, scenario, scenario_geography,
        'scen_tech_prod_' || year, ROUND(scen_tech_prod, 6) FROM factors"""
    ),
    "comm_values_wide": _q(
        f"""SELECT technology, ald_sector, company_name, scenario, scenario_geography,
        {_r(*[f'{s}_tech_prod_{y}' for y in (T0, T1) for s in ('plan', 'scen')])} FROM comm_wide"""
    ),
    "comm_plan": _q(
        f"""SELECT w.technology, w.ald_sector, w.company_name, w.scenario, w.scenario_geography, type,
        ROUND(plan_tech_share, 6) AS plan_tech_share, ROUND(scen_tech_share, 6) AS scen_tech_share,
        ROUND(scenario_change, 6) AS scenario_change, ROUND(production_change, 6) AS production_change,
        ROUND(tech_allocation_weight, 6) AS tech_allocation_weight,
        ROUND(trajectory_alignment, 6) AS trajectory_alignment, ROUND(weight_share, 6) AS weighting_factor,
        ROUND(score, 6) AS "single_score_Case8",
        {_r(*[f'{s}_tech_prod_{y}' for y in (T0, T1) for s in ('plan', 'scen')])}
        FROM comm_end e RIGHT JOIN comm_wide w ON e.technology = w.technology AND e.ald_sector = w.ald_sector
          AND e.company_name = w.company_name AND e.scenario = w.scenario
          AND e.scenario_geography = w.scenario_geography"""
    ),
    "report_power": _tech_report("Power"),
    "report_auto": _tech_report("Automotive"),
    "report_left_out": _tech_report("Automotive", with_truck_maker=True),
    "report_intensity": _q(
        f"""SELECT r."Company",
        CASE WHEN r.sector = 'Cement' THEN traffic_light
          ELSE COALESCE(traffic_light, {_text(refdata.MISSING_LIGHT_TEXT)}) END AS overall_light,
        CASE WHEN r.sector = 'Steel' AND gap IS NULL THEN {_text(refdata.MISSING_VALUE_TEXT)}
          ELSE alignement_classement END AS overall_value,
        r.sector AS sheet
        FROM rosters r LEFT JOIN ei_result e ON e.company_name = r."Company" AND e.ald_sector = r.sector
        WHERE r.sector IN ('Cement', 'Steel', 'Aviation')"""
    ),
    "roster_skip": _q(
        """SELECT CASE sector WHEN 'Power' THEN 'Electric Utilities' WHEN 'Automotive' THEN 'Autos' ELSE sector END AS sheet,
        "Company" FROM rosters WHERE sector <> 'HDV'"""
    ),
}
ORACLES["report_book"] = ORACLES["report_intensity"]
