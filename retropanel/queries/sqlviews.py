"""Shared view texts for the SQL twins: the same role bindings as ``bindings.py``."""

from __future__ import annotations

from retropanel import settings as S
from retropanel.sources.dimensions import EQUIPMENT_ROWS, REGION_ROWS, geo_rows

START, AS_OF = "1996-01-01", "2001-06-30"
START_ID = 199601
TRAIN_END, VAL_END = 199912, 200006


def he(x: str, digits: int) -> str:
    """Half-even rounding by scaling, as the Spark side does it."""
    return f"(round_even(CAST({x} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def clip(x: str, low: float, high: float) -> str:
    return f"(CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END)"


def pct(a: str, b: str, digits: int = 2) -> str:
    return he(f"1e2 * ({a}) / greatest({b}, 1)", digits)


def values(rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def pad(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return f"(CASE WHEN length({t}) < 2 THEN lpad({t}, 2, '0') ELSE {t} END)"


def date_id(x: str) -> str:
    return f"CAST(year({x}) * 100 + month({x}) AS INTEGER)"


def pac(*texts: str) -> str:
    hits = " OR ".join(f"regexp_matches(coalesce({t}, ''), '{S.HEAT_PUMP_PATTERN}')" for t in texts)
    return f"CAST(({hits}) AS INTEGER)"


def change(cur: str, prev: str) -> str:
    return (
        f"(CASE WHEN {prev} = 0 AND {cur} > 0 THEN CAST('infinity' AS DOUBLE) "
        f"WHEN {prev} = 0 AND {cur} < 0 THEN CAST('-infinity' AS DOUBLE) "
        f"WHEN {prev} <> 0 THEN (CAST({cur} AS DOUBLE) / {prev} - 1) * 100 END)"
    )


def next_id(x: str, k: str = "1") -> str:
    t = f"(({x}) // 100 * 12 + ({x}) % 100 - 1 + {k})"
    return f"CAST({t} // 12 * 100 + {t} % 12 + 1 AS INTEGER)"


LABEL = (
    "CASE WHEN o_totalprice < 50000 THEN 'A' WHEN o_totalprice < 100000 THEN 'B' "
    "WHEN o_totalprice < 150000 THEN 'C' WHEN o_totalprice < 200000 THEN 'D' "
    "WHEN o_totalprice < 250000 THEN 'E' WHEN o_totalprice < 300000 THEN 'F' "
    "WHEN o_totalprice < 350000 THEN 'G' ELSE 'N/A' END"
)
HEATING = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'PAC air/eau' WHEN '2-HIGH' THEN 'Chaudiere gaz  ' "
    "WHEN '3-MEDIUM' THEN 'Pompe a chaleur geothermique' WHEN '4-NOT SPECIFIED' THEN "
    "'Radiateur electrique' ELSE 'Poele bois' END"
)
COOLING = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'PAC reversible' WHEN 'MACHINERY' THEN 'Climatisation' "
    "WHEN 'HOUSEHOLD' THEN NULL ELSE '' END"
)

VIEWS: dict[str, str] = {}

VIEWS["v_geo"] = (
    "SELECT * FROM (VALUES "
    + values(geo_rows())
    + ") AS g(dept, dept_name, city_ref, latitude, longitude, region_code, elevation, geo_id)"
)
VIEWS["v_region"] = (
    "SELECT * FROM (VALUES "
    + values(REGION_ROWS)
    + ") AS r(region_code, region_name)"
)
VIEWS["v_equipment"] = (
    "SELECT * FROM (VALUES "
    + values(
        EQUIPMENT_ROWS
    )
    + ") AS e(label, category, energy_source, is_renewable)"
)
VIEWS["v_cert_raw"] = f"""
SELECT o_orderkey AS numero_dpe, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_etablissement_dpe,
  CAST(c_nationkey + 1 AS VARCHAR) AS code_departement_ban, {LABEL} AS etiquette_dpe,
  {HEATING} AS type_generateur_chauffage_principal, {COOLING} AS type_generateur_froid,
  CAST(floor(o_totalprice / 400) AS DOUBLE) AS surface_habitable_logement,
  CAST(floor(o_totalprice / 300) AS DOUBLE) AS conso_5_usages_par_m2_ep,
  CAST(floor(o_totalprice / 9) AS DOUBLE) AS cout_total_5_usages
FROM orders JOIN customer ON o_custkey = c_custkey"""
VIEWS["v_cert"] = f"""
SELECT numero_dpe, CAST(date_etablissement_dpe AS DATE) AS date_etablissement_dpe,
  {pad('code_departement_ban')} AS code_departement_ban, trim(etiquette_dpe) AS etiquette_dpe,
  trim(type_generateur_chauffage_principal) AS type_generateur_chauffage_principal,
  trim(type_generateur_froid) AS type_generateur_froid,
  {clip('surface_habitable_logement', 5, 1000)} AS surface_habitable_logement,
  {clip('conso_5_usages_par_m2_ep', 0, 1000)} AS conso_5_usages_par_m2_ep,
  {clip('cout_total_5_usages', 0, 50000)} AS cout_total_5_usages,
  CAST(year(CAST(date_etablissement_dpe AS DATE)) AS INTEGER) AS year,
  CAST(month(CAST(date_etablissement_dpe AS DATE)) AS INTEGER) AS month,
  {date_id('CAST(date_etablissement_dpe AS DATE)')} AS date_id,
  {pac('trim(type_generateur_chauffage_principal)', 'trim(type_generateur_froid)')} AS is_pac,
  CAST(length(coalesce(trim(type_generateur_froid), '')) > 0 AS INTEGER) AS is_clim,
  CAST(coalesce(etiquette_dpe IN ('A', 'B'), FALSE) AS INTEGER) AS is_classe_ab
FROM v_cert_raw
WHERE CAST(date_etablissement_dpe AS DATE) BETWEEN DATE '{START}' AND DATE '{AS_OF}'
  AND etiquette_dpe IN ('A','B','C','D','E','F','G')
  AND {pad('code_departement_ban')} IN (SELECT dept FROM v_geo)"""
VIEWS["v_facts"] = f"""
SELECT date_id, code_departement_ban AS dept, count(is_pac) AS nb_dpe_total,
  CAST(sum(is_pac) AS BIGINT) AS nb_installations_pac, CAST(sum(is_clim) AS BIGINT) AS nb_installations_clim,
  CAST(sum(is_classe_ab) AS BIGINT) AS nb_dpe_classe_ab,
  {pct('sum(is_pac)', 'count(is_pac)')} AS pct_pac, {pct('sum(is_clim)', 'count(is_pac)')} AS pct_clim,
  {pct('sum(is_classe_ab)', 'count(is_pac)')} AS pct_classe_ab
FROM v_cert GROUP BY date_id, code_departement_ban"""
VIEWS["v_wx_raw"] = """
SELECT CAST(l_shipdate AS DATE) AS time, CAST(s_nationkey + 1 AS VARCHAR) AS dept,
  CASE WHEN l_quantity = 50 THEN NULL ELSE l_quantity * 2 - 40 END AS temperature_2m_mean,
  CASE WHEN l_quantity = 50 THEN NULL ELSE l_quantity * 2 - 35 END AS temperature_2m_max,
  CASE WHEN l_quantity = 50 THEN NULL ELSE l_quantity * 2 - 45 END AS temperature_2m_min,
  CAST(round(l_tax * 100) * 45 AS DOUBLE) AS precipitation_sum,
  CAST(round(l_discount * 100) * 22 AS DOUBLE) AS wind_speed_10m_max,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
WX_ORDER = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
VIEWS["v_wx_last"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY time, dept ORDER BY {WX_ORDER}) AS rn
  FROM v_wx_raw) WHERE rn = 1"""
VIEWS["v_wx"] = f"""
SELECT time, {pad('dept')} AS dept,
  {clip('temperature_2m_mean', -30, 50)} AS temperature_2m_mean,
  {clip('temperature_2m_max', -30, 50)} AS temperature_2m_max,
  {clip('temperature_2m_min', -30, 50)} AS temperature_2m_min,
  {clip('precipitation_sum', 0, 300)} AS precipitation_sum,
  {clip('wind_speed_10m_max', 0, 200)} AS wind_speed_10m_max,
  greatest(0, 18 - {clip('temperature_2m_mean', -30, 50)}) AS hdd,
  greatest(0, {clip('temperature_2m_mean', -30, 50)} - 18) AS cdd,
  {date_id('time')} AS date_id
FROM v_wx_last
WHERE NOT (temperature_2m_mean IS NULL AND temperature_2m_max IS NULL AND temperature_2m_min IS NULL)"""
VIEWS["v_wx_month"] = f"""
SELECT date_id, dept, {he('avg(temperature_2m_mean)', 2)} AS temp_mean,
  {he('max(temperature_2m_max)', 2)} AS temp_max, {he('min(temperature_2m_min)', 2)} AS temp_min,
  {he('coalesce(sum(precipitation_sum), 0)', 2)} AS precipitation_sum,
  {he('max(wind_speed_10m_max)', 2)} AS wind_max,
  {he('coalesce(sum(hdd), 0)', 2)} AS hdd_sum, {he('coalesce(sum(cdd), 0)', 2)} AS cdd_sum,
  CAST(sum(CASE WHEN temperature_2m_max > 35 THEN 1 ELSE 0 END) AS BIGINT) AS nb_jours_canicule,
  CAST(sum(CASE WHEN temperature_2m_min < 0 THEN 1 ELSE 0 END) AS BIGINT) AS nb_jours_gel,
  CAST(sum(CASE WHEN temperature_2m_min < -7 THEN 1 ELSE 0 END) AS BIGINT) AS nb_jours_pac_inefficient
FROM v_wx GROUP BY date_id, dept"""


def _eco(period: str, batch: int, where: str) -> str:
    v = "CAST(floor(o_totalprice) AS DOUBLE)"
    m = "month(o_orderdate)"
    return f"""
SELECT {period} AS period, {batch} AS batch_no, avg({v}) / 2500 AS confiance_menages,
  avg({v}) FILTER (WHERE o_orderpriority = '1-URGENT') / 2500 AS climat_affaires_industrie,
  avg({v}) FILTER (WHERE {m} NOT IN (5, 6, 7, 8, 9)) / 2500 AS climat_affaires_batiment,
  avg({v}) FILTER (WHERE o_orderpriority = '2-HIGH') / 2500 - 100 AS opinion_achats_importants,
  avg({v}) FILTER (WHERE o_orderpriority = '5-LOW' AND {m} NOT IN (3, 11)) / 2500 - 100 AS situation_financiere_future,
  avg({v}) FILTER (WHERE o_orderpriority = '3-MEDIUM') / 2500 AS ipi_industrie_manuf
FROM orders {where} GROUP BY 1"""


VIEWS["v_eco_raw"] = " UNION ALL ".join(
    [
        _eco("strftime(o_orderdate, '%Y-%m')", 1, ""),
        _eco("strftime(o_orderdate, '%Y-%m')", 2, "WHERE o_orderstatus = 'O'"),
        _eco("CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)", 1, ""),
    ]
)
VIEWS["v_eco_last"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY batch_no DESC) AS rn,
  CAST(replace(period, '-', '') AS INTEGER) AS date_id
  FROM v_eco_raw WHERE regexp_matches(period, '^\\d{4}-\\d{2}$')) WHERE rn = 1"""


def interpolated(value: str, part: str, order: str = "date_id") -> str:
    """Columns ``pos, pv, pp, nv, np`` needed to fill ``value`` inside a series."""
    p = f"PARTITION BY {part} " if part else ""
    w = f"OVER ({p}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    f = f"OVER ({p}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return (
        f"last_value({value} IGNORE NULLS) {w} AS pv_{value}, "
        f"last_value(CASE WHEN {value} IS NOT NULL THEN pos END IGNORE NULLS) {w} AS pp_{value}, "
        f"first_value({value} IGNORE NULLS) {f} AS nv_{value}, "
        f"first_value(CASE WHEN {value} IS NOT NULL THEN pos END IGNORE NULLS) {f} AS np_{value}"
    )


def filled(value: str, limit: int = 3) -> str:
    v = value
    line = f"pv_{v} + (nv_{v} - pv_{v}) * (pos - pp_{v}) / (np_{v} - pp_{v})"
    return (
        f"(CASE WHEN {v} IS NOT NULL THEN {v} WHEN pos - pp_{v} <= {limit} THEN "
        f"CASE WHEN nv_{v} IS NULL THEN pv_{v} ELSE {line} END END)"
    )


ECO = list(S.ECONOMY_NAMES)
VIEWS["v_eco"] = (
    "SELECT date_id, period, "
    + ", ".join(f"{he(filled(c), 2)} AS {c}" for c in ECO)
    + " FROM (SELECT *, "
    + ", ".join(interpolated(c, "") for c in ECO)
    + " FROM (SELECT *, row_number() OVER (ORDER BY date_id) AS pos FROM v_eco_last))"
)


def _ind(period: str) -> str:
    return f"""
SELECT {period} AS period, CASE l_returnflag WHEN 'A' THEN 'C25' WHEN 'N' THEN 'C28' ELSE 'C2825' END AS nace_r2,
  1 AS batch_no,
  avg(CAST(floor(l_extendedprice) AS DOUBLE)) FILTER (WHERE NOT (l_returnflag = 'N' AND month(l_shipdate) IN (4, 5))) / 500 AS ipi_value
FROM lineitem GROUP BY 1, 2"""


VIEWS["v_ind_raw"] = " UNION ALL ".join(
    [
        _ind("strftime(l_shipdate, '%Y-%m')"),
        _ind("CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR)"),
    ]
)
VIEWS["v_ind"] = (
    f"SELECT date_id, period, nace_r2, {he(filled('ipi_value'), 2)} AS ipi_value FROM (SELECT *, "
    + interpolated("ipi_value", "nace_r2")
    + " FROM (SELECT *, CAST(replace(period, '-', '') AS INTEGER) AS date_id, "
    + "row_number() OVER (PARTITION BY nace_r2 ORDER BY period) AS pos "
    + "FROM v_ind_raw WHERE regexp_matches(period, '^\\d{4}-\\d{2}$')))"
)
VIEWS["v_ind_wide"] = """
SELECT date_id, max(ipi_value) FILTER (WHERE nace_r2 = 'C28') AS ipi_hvac_c28,
  max(ipi_value) FILTER (WHERE nace_r2 = 'C2825') AS ipi_hvac_c2825 FROM v_ind GROUP BY date_id"""
VIEWS["v_eco_wide"] = (
    "SELECT coalesce(e.date_id, i.date_id) AS date_id, "
    + ", ".join(f"e.{k} AS {v}" for k, v in S.ECONOMY_NAMES.items())
    + ", i.ipi_hvac_c28, i.ipi_hvac_c2825 FROM v_eco e FULL OUTER JOIN v_ind_wide i ON e.date_id = i.date_id"
)
VIEWS["v_permit_raw"] = """
SELECT CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS DATE_PRISE_EN_COMPTE,
  CAST(s_nationkey + 1 AS VARCHAR) AS DEP,
  l_quantity AS NB_LGT_TOT_CREES, CAST(l_linenumber AS DOUBLE) AS NB_LGT_IND_CREES,
  CAST(floor(l_extendedprice / 10000) AS DOUBLE) AS NB_LGT_COLL_CREES,
  CAST(floor(l_extendedprice) AS DOUBLE) AS SURF_TOT_M2
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
VIEWS["v_permit"] = f"""
SELECT CAST(replace(substring(DATE_PRISE_EN_COMPTE, 1, 7), '-', '') AS INTEGER) AS date_id, {pad('DEP')} AS dept,
  sum(NB_LGT_TOT_CREES) AS nb_logements_autorises, sum(NB_LGT_IND_CREES) AS nb_logements_individuels,
  sum(NB_LGT_COLL_CREES) AS nb_logements_collectifs, sum(SURF_TOT_M2) AS surface_autorisee_m2
FROM v_permit_raw GROUP BY 1, 2"""
VIEWS["v_attr_raw"] = f"""
SELECT CAST(c_nationkey + 1 AS VARCHAR) AS dept,
  {he('avg(CAST(floor(c_acctbal) AS DOUBLE))', 2)} AS revenu_median,
  count(*) * 100 AS nb_logements_total,
  {he("1e2 * count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') / count(*)", 1)} AS pct_maisons,
  CAST(floor(avg(CAST(floor(c_acctbal) AS DOUBLE)) / 5) AS DOUBLE) AS altitude_mean,
  {he("3e2 * count(*) FILTER (WHERE c_mktsegment = 'BUILDING') / count(*)", 1)} AS pct_zone_montagne,
  CAST(count(*) FILTER (WHERE c_acctbal > 0) AS DOUBLE) AS densite_pop
FROM customer GROUP BY c_nationkey"""
VIEWS["v_attr"] = f"""
SELECT {pad('a.dept')} AS dept, revenu_median, nb_logements_total, pct_maisons, altitude_mean, pct_zone_montagne,
  densite_pop, coalesce(elevation, 0) AS altitude
FROM v_attr_raw a LEFT JOIN v_geo g ON {pad('a.dept')} = g.dept"""
TIME = f"""
  CAST(date_id // 100 AS INTEGER) AS year, CAST(date_id % 100 AS INTEGER) AS month,
  CAST((date_id % 100 - 1) // 3 + 1 AS INTEGER) AS quarter,
  CAST(date_id % 100 IN (1, 2, 3, 10, 11, 12) AS INTEGER) AS is_heating,
  CAST(date_id % 100 IN (6, 7, 8, 9) AS INTEGER) AS is_cooling,
  {he('sin(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_sin,
  {he('cos(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_cos"""
VIEWS["v_panel"] = f"""
SELECT f.*, w.* EXCLUDE (date_id, dept), e.* EXCLUDE (date_id), p.* EXCLUDE (date_id, dept), a.* EXCLUDE (dept),
  {TIME.replace('date_id', 'f.date_id')}, g.dept_name, g.city_ref, g.latitude, g.longitude,
  {he('1e3 * (CAST(f.nb_installations_pac AS DOUBLE) / greatest(a.nb_logements_total, 1))', 4)} AS pac_per_1000_logements,
  {he('1e3 * (CAST(f.nb_installations_clim AS DOUBLE) / greatest(a.nb_logements_total, 1))', 4)} AS clim_per_1000_logements
FROM v_facts f
LEFT JOIN v_wx_month w ON f.date_id = w.date_id AND f.dept = w.dept
LEFT JOIN v_eco_wide e ON f.date_id = e.date_id
LEFT JOIN v_permit p ON f.date_id = p.date_id AND f.dept = p.dept
LEFT JOIN v_attr a ON f.dept = a.dept
LEFT JOIN v_geo g ON f.dept = g.dept
WHERE f.date_id >= {START_ID}"""
