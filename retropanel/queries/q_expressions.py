"""Projections, filters, cleaning expressions and derived scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import cleaning as C
from retropanel.operators.reshape import unpivot_values
from retropanel.plans import features as P
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import AS_OF, START, clip, date_id, he, next_id, pac, pad, pct
from retropanel.sources.dimensions import departments_for_scope, equipment_dimension, geo_dimension


@query(
    "p1_permissive_dates",
    """SELECT doc_id, TRY_CAST(source AS DATE) AS parsed FROM documents WHERE TRY_CAST(source AS DATE) IS NOT NULL
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus <> 'P'""",
)
def p1(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", F.col("source").alias("t"))
    days = B.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "P", "2024-13-45")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("t"),
    )
    return docs.unionByName(days).select("doc_id", E.parse_date("t").alias("parsed")).filter(
        F.col("parsed").isNotNull()
    )


@query(
    "p2_period_columns",
    f"""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  {date_id('o_orderdate')} AS date_id FROM orders""",
)
def p2(spark, sf):
    d = F.col("o_orderdate")
    return B.table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), E.date_id(d).alias("date_id")
    )


@query("p3_monthly_filter", "SELECT period, confiance_menages FROM v_eco_raw WHERE regexp_matches(period, '^\\d{4}-\\d{2}$')")
def p3(spark, sf):
    return B.eco_raw(spark, sf).filter(E.is_monthly("period")).select("period", "confiance_menages")


@query(
    "p4_period_to_id",
    """SELECT DATE_PRISE_EN_COMPTE AS period, CAST(replace(substring(DATE_PRISE_EN_COMPTE, 1, 7), '-', '') AS INTEGER) AS date_id,
  count(*) AS n FROM v_permit_raw GROUP BY 1, 2""",
)
def p4(spark, sf):
    return B.permit_raw(spark, sf).groupBy(
        F.col("DATE_PRISE_EN_COMPTE").alias("period"), E.period_to_id("DATE_PRISE_EN_COMPTE").alias("date_id")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("p5_pad_codes", f"SELECT c_custkey, {pad('c_custkey')} AS code FROM customer")
def p5(spark, sf):
    return B.table(spark, sf, "customer").select("c_custkey", E.pad_code("c_custkey").alias("code"))


@query(
    "p6_valid_domain",
    f"""SELECT numero_dpe, etiquette_dpe, {pad('code_departement_ban')} AS dept FROM v_cert_raw
WHERE etiquette_dpe IN ('A','B','C','D','E','F','G') AND {pad('code_departement_ban')} IN (SELECT dept FROM v_geo)""",
)
def p6(spark, sf):
    valid = B.cert_raw(spark, sf).filter(F.col("etiquette_dpe").isin(*S.VALID_LABELS))
    keyed = valid.select("numero_dpe", "etiquette_dpe", E.pad_code("code_departement_ban").alias("dept"))
    return keyed.join(F.broadcast(geo_dimension(spark).select("dept")), "dept", "left_semi")


@query(
    "p7_date_range",
    f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{AS_OF}'",
)
def p7(spark, sf):
    lo, hi = F.lit(START).cast("timestamp_ntz"), F.date_add(F.lit(AS_OF).cast("date"), 1).cast("timestamp_ntz")
    d = F.col("o_orderdate")  # the bare column is compared, so the range reaches the file scan
    return B.table(spark, sf, "orders").filter((d >= lo) & (d < hi)).select(
        "o_orderkey", d.cast("date").alias("day")
    )


@query("p8_period_cutoff", "SELECT date_id, dept, nb_dpe_total FROM v_facts WHERE date_id >= 199801")
def p8(spark, sf):
    return B.facts(spark, sf).filter("date_id >= 199801").select("date_id", "dept", "nb_dpe_total")


@query(
    "p9_clip_and_count",
    f"""SELECT sum({clip('surface_habitable_logement', 5, 1000)}) AS surface, sum({clip('cout_total_5_usages', 0, 50000)}) AS cost,
  CAST(sum(CAST(surface_habitable_logement < 5 OR surface_habitable_logement > 1000 AS INTEGER) +
      CAST(conso_5_usages_par_m2_ep > 1000 AS INTEGER) + CAST(cout_total_5_usages > 50000 AS INTEGER)) AS BIGINT) AS clipped
FROM v_cert_raw""",
)
def p9(spark, sf):
    raw = B.cert_raw(spark, sf)
    counted = raw.withColumn("_n", C.clipped_values(raw, S.CERTIFICATE_BOUNDS))
    return C.clip_columns(counted, S.CERTIFICATE_BOUNDS).agg(
        F.sum("surface_habitable_logement").alias("surface"),
        F.sum("cout_total_5_usages").alias("cost"),
        F.sum("_n").alias("clipped"),
    )


@query("p10_drop_all_null", "SELECT time, dept, l_orderkey FROM v_wx_raw WHERE temperature_2m_mean IS NOT NULL")
def p10(spark, sf):
    temps = ["temperature_2m_mean", "temperature_2m_max", "temperature_2m_min"]
    return B.wx_raw(spark, sf).na.drop("all", subset=temps).select("time", "dept", "l_orderkey")


@query(
    "p11_trim_strings",
    "SELECT doc_id, trim(substring(text, 1, length(text) - 1)) AS text, trim(lang) AS lang FROM documents",
)
def p11(spark, sf):
    docs = B.table(spark, sf, "documents").select(
        "doc_id", F.expr("substring(text, 1, length(text) - 1)").alias("text"), "lang"
    )
    return E.trim_strings(docs)


@query(
    "p12_round_doubles",
    f"""SELECT event_type, {he('sum(CAST(floor(value) AS DOUBLE)) / count(*)', 2)} AS mean_value,
  {he('min(value) / 3', 2)} AS third FROM events GROUP BY event_type""",
)
def p12(spark, sf):
    means = B.table(spark, sf, "events").groupBy("event_type").agg(
        F.avg(F.floor("value").cast("double")).alias("mean_value"), (F.min("value") / 3).alias("third")
    )
    return E.round_doubles(means, 2)


@query(
    "p13_degree_days",
    """SELECT time, dept, l_orderkey, l_linenumber, l_partkey, CASE WHEN temperature_2m_mean IS NOT NULL THEN greatest(0, 18 - temperature_2m_mean) END AS hdd,
  CASE WHEN temperature_2m_mean IS NOT NULL THEN greatest(0, temperature_2m_mean - 18) END AS cdd FROM v_wx_raw""",
)
def p13(spark, sf):
    return C.degree_days(B.wx_raw(spark, sf)).select(
        "time", "dept", "l_orderkey", "l_linenumber", "l_partkey", "hdd", "cdd"
    )


@query(
    "p14_threshold_days",
    """SELECT time, dept, CAST(sum(CASE WHEN temperature_2m_max > 35 THEN 1 ELSE 0 END) AS BIGINT) AS heatwave,
  CAST(sum(CASE WHEN temperature_2m_min < 0 THEN 1 ELSE 0 END) AS BIGINT) AS frost,
  CAST(sum(CASE WHEN temperature_2m_min < -7 THEN 1 ELSE 0 END) AS BIGINT) AS inefficient FROM v_wx_raw GROUP BY 1, 2""",
)
def p14(spark, sf):
    return B.wx_raw(spark, sf).groupBy("time", "dept").agg(
        F.sum(E.above("temperature_2m_max", S.HEATWAVE_ABOVE)).alias("heatwave"),
        F.sum(E.below("temperature_2m_min", S.FROST_BELOW)).alias("frost"),
        F.sum(E.below("temperature_2m_min", S.PUMP_INEFFICIENT_BELOW)).alias("inefficient"),
    )


@query(
    "p15_heat_pump_text",
    f"""SELECT numero_dpe, {pac('type_generateur_chauffage_principal', 'type_generateur_froid')} AS is_pac FROM v_cert_raw
UNION ALL SELECT doc_id, {pac('text', 'source')} FROM documents""",
)
def p15(spark, sf):
    certs = B.cert_raw(spark, sf).select(
        "numero_dpe", E.is_heat_pump("type_generateur_chauffage_principal", "type_generateur_froid").alias("is_pac")
    )
    docs = B.table(spark, sf, "documents").select(
        F.col("doc_id").alias("numero_dpe"), E.is_heat_pump("text", "source").alias("is_pac")
    )
    return certs.unionByName(docs)


@query(
    "p16_text_and_set_flags",
    """SELECT numero_dpe, CAST(length(coalesce(type_generateur_froid, '')) > 0 AS INTEGER) AS is_clim,
  CAST(etiquette_dpe IN ('A', 'B') AS INTEGER) AS is_classe_ab FROM v_cert_raw""",
)
def p16(spark, sf):
    return B.cert_raw(spark, sf).select(
        "numero_dpe",
        E.has_text("type_generateur_froid").alias("is_clim"),
        E.in_set("etiquette_dpe", S.HIGH_LABELS).alias("is_classe_ab"),
    )


@query(
    "p17_rename_by_alias",
    "SELECT DEP, DATE_PRISE_EN_COMPTE, NB_LGT_COLL_CREES, SURF_TOT_M2 FROM v_permit_raw",
)
def p17(spark, sf):
    fresh = B.permit_raw(spark, sf).select(
        F.col("DEP").alias("DEP_CODE"),
        F.col("DATE_PRISE_EN_COMPTE").alias("DATE_REELLE_AUTORISATION"),
        F.col("NB_LGT_COLL_CREES").alias("NB_LGT_COL_CREES"),
        "SURF_TOT_M2",
    )
    return E.rename_absent(fresh, S.PERMIT_ALIASES)


@query("p18_first_present_column", "SELECT max(temperature_2m_mean) AS warmest FROM v_wx_raw")
def p18(spark, sf):
    df = B.wx_raw(spark, sf)
    name = E.first_present(df, ["temp_mean", "temperature_2m_mean"])
    return df.agg(F.max(name).alias("warmest"))


@query(
    "p19_optional_predicates",
    "SELECT period, nace_r2, ipi_value FROM v_ind_raw WHERE nace_r2 IN ('C28', 'C2825') AND batch_no = 1",
)
def p19(spark, sf):
    df = B.ind_raw(spark, sf)
    wanted = {"nace_r2": ["C28", "C2825"], "batch_no": [1], "s_adj": ["SCA"], "unit": ["I21"]}
    for name in E.present(df, wanted):
        df = df.filter(F.col(name).isin(*wanted[name]))
    return df.select("period", "nace_r2", "ipi_value")


@query("p20_drop_artefact", "SELECT user_id, event_type, value FROM events")
def p20(spark, sf):
    events = B.table(spark, sf, "events").select("user_id", "event_type", "value", F.lit(1.0).alias("_score"))
    return events.drop("_score")


@query(
    "p21_not_null_scan",
    "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_shipdate IS NOT NULL AND l_suppkey IS NOT NULL",
)
def p21(spark, sf):
    return B.table(spark, sf, "lineitem").filter("l_shipdate IS NOT NULL AND l_suppkey IS NOT NULL").select(
        "l_orderkey", "l_shipdate"
    )


@query(
    "p22_skip_rules",
    f"""SELECT numero_dpe, surface_habitable_logement, {pad('code_departement_ban')} AS code_departement_ban, etiquette_dpe
FROM v_cert_raw WHERE etiquette_dpe IN ('A','B','C','D','E','F','G')""",
)
def p22(spark, sf):
    skip = frozenset({"filter_invalid_dates", "filter_invalid_depts", "clip_outliers"})
    return B.cert(spark, sf, skip).select(
        "numero_dpe", "surface_habitable_logement", "code_departement_ban", "etiquette_dpe"
    )


@query(
    "p23_equipment_classes",
    """SELECT coalesce(e.category, 'unknown') AS category, coalesce(e.energy_source, 'unknown') AS energy_source,
  coalesce(e.is_renewable, FALSE) AS is_renewable, count(*) AS n, sum(cout_total_5_usages) AS cost
FROM v_cert c LEFT JOIN v_equipment e ON e.label = CASE c.type_generateur_chauffage_principal
  WHEN 'PAC air/eau' THEN 'PAC air-eau' WHEN 'Chaudiere gaz' THEN 'Chaudière gaz' WHEN 'Radiateur electrique' THEN 'Radiateur électrique'
  WHEN 'Poele bois' THEN 'Poêle à bois' ELSE c.type_generateur_chauffage_principal END GROUP BY 1, 2, 3""",
)
def p23(spark, sf):
    spelling = {
        "PAC air/eau": "PAC air-eau",
        "Chaudiere gaz": "Chaudière gaz",
        "Radiateur electrique": "Radiateur électrique",
        "Poele bois": "Poêle à bois",
    }
    df = B.cert(spark, sf).select(
        F.col("type_generateur_chauffage_principal").alias("label"), "cout_total_5_usages"
    )
    named = df.replace(spelling, subset=["label"])
    joined = named.join(F.broadcast(equipment_dimension(spark)), "label", "left")
    return joined.groupBy(
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("energy_source", F.lit("unknown")).alias("energy_source"),
        F.coalesce("is_renewable", F.lit(False)).alias("is_renewable"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("cout_total_5_usages").alias("cost"))


@query("p24_non_negative", "SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer")
def p24(spark, sf):
    return B.table(spark, sf, "customer").select("c_custkey", E.non_negative("c_acctbal").alias("balance"))


@query(
    "p25_terrain_classes",
    """SELECT dept, CASE WHEN altitude_mean > 800 OR pct_zone_montagne > 50 THEN 'MOUNTAIN'
  WHEN pct_zone_montagne > 15 OR altitude_mean > 400 THEN 'SEMI-MOUNTAIN' WHEN densite_pop > 500 THEN 'URBAN' ELSE 'LOWLAND' END AS terrain
FROM v_attr_raw""",
)
def p25(spark, sf):
    return B.attr_raw(spark, sf).select(
        "dept", E.terrain("altitude_mean", "pct_zone_montagne", "densite_pop").alias("terrain")
    )


COP = "4.5 - 0.0005 * altitude_mean"


@query(
    "p26_viability_bands",
    f"""SELECT dept, {clip(f'CAST({COP} AS DOUBLE)', 1, 5)} AS cop, CASE WHEN {COP} < 3 THEN 'LOW' WHEN {COP} < 4 THEN 'MODERATE' ELSE 'HIGH' END AS viability FROM v_attr_raw""",
)
def p26(spark, sf):
    cop = E.clip(F.lit(4.5) - F.lit(0.0005) * F.col("altitude_mean"), 1.0, 5.0)
    return B.attr_raw(spark, sf).select("dept", cop.alias("cop")).withColumn("viability", E.viability_band("cop"))


@query(
    "p27_scope_selection",
    f"""SELECT c_custkey, {pad('c_nationkey + 1')} AS dept FROM customer WHERE {pad('c_nationkey + 1')} IN (SELECT dept FROM v_geo WHERE region_code = '84')""",
)
def p27(spark, sf):
    scope = geo_dimension(spark).filter("region_code = '84'").select("dept")
    assert len(departments_for_scope("84")) == 12
    return (
        B.table(spark, sf, "customer")
        .select("c_custkey", E.pad_code(F.col("c_nationkey") + 1).alias("dept"))
        .join(F.broadcast(scope), "dept", "left_semi")
    )


# --- scalar functions and features ---------------------------------------------------------


@query("f1_calendar_parts", f"SELECT DISTINCT date_id, CAST(date_id // 100 AS INTEGER) AS year, CAST(date_id % 100 AS INTEGER) AS month, CAST((date_id % 100 - 1) // 3 + 1 AS INTEGER) AS quarter FROM (SELECT {date_id('ts')} AS date_id FROM events UNION ALL SELECT {date_id('o_orderdate')} FROM orders)")
def f1(spark, sf):
    ids = B.table(spark, sf, "events").select(E.date_id("ts").alias("date_id")).unionByName(
        B.table(spark, sf, "orders").select(E.date_id("o_orderdate").alias("date_id"))
    )
    m = E.month_of("date_id")
    return ids.distinct().select(
        "date_id", E.year_of("date_id").alias("year"), m.alias("month"), E.quarter_of(m).alias("quarter")
    )


@query(
    "f2_season_flags",
    """SELECT o_orderkey, CAST(month(o_orderdate) IN (1,2,3,10,11,12) AS INTEGER) AS is_heating,
  CAST(month(o_orderdate) IN (6,7,8,9) AS INTEGER) AS is_cooling FROM orders""",
)
def f2(spark, sf):
    m = F.month("o_orderdate")
    return B.table(spark, sf, "orders").select(
        "o_orderkey", E.is_heating(m).alias("is_heating"), E.is_cooling(m).alias("is_cooling")
    )


@query(
    "f3_cyclic_month",
    f"""SELECT DISTINCT date_id, {he('sin(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_sin,
  {he('cos(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_cos FROM v_facts""",
)
def f3(spark, sf):
    m = E.month_of("date_id")
    return B.facts(spark, sf).select("date_id").distinct().select(
        "date_id", E.month_sin(m).alias("month_sin"), E.month_cos(m).alias("month_cos")
    )


@query(
    "f4_season_labels",
    """SELECT CASE WHEN month(o_orderdate) IN (12,1,2) THEN 'Winter' WHEN month(o_orderdate) IN (3,4,5) THEN 'Spring'
  WHEN month(o_orderdate) IN (6,7,8) THEN 'Summer' ELSE 'Fall' END AS season, count(*) AS n FROM orders GROUP BY 1""",
)
def f4(spark, sf):
    return B.table(spark, sf, "orders").groupBy(E.season(F.month("o_orderdate")).alias("season")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("f5_id_to_date", "SELECT DISTINCT date_id, make_date(date_id // 100, date_id % 100, 1) AS month_start FROM v_facts")
def f5(spark, sf):
    return B.facts(spark, sf).select("date_id").distinct().withColumn("month_start", E.id_to_date("date_id"))


@query(
    "f6_month_arithmetic",
    f"SELECT DISTINCT date_id, {next_id('date_id')} AS plus_1, {next_id('date_id', '17')} AS plus_17, {next_id('date_id', '-13')} AS minus_13 FROM v_facts",
)
def f6(spark, sf):
    return B.facts(spark, sf).select("date_id").distinct().select(
        "date_id",
        E.shift_month("date_id", 1).alias("plus_1"),
        E.shift_month("date_id", 17).alias("plus_17"),
        E.shift_month("date_id", -13).alias("minus_13"),
    )


MAXIMA = "(SELECT greatest(max(hdd_sum), 1) AS hdd, greatest(max(cdd_sum), 1) AS cdd, greatest(max(nb_jours_gel), 1) AS gel, greatest(max(altitude_mean), 1) AS alt, greatest(max(densite_pop), 1) AS dens FROM v_panel) m"
GEL = "CAST(coalesce(nb_jours_gel, 0) AS DOUBLE)"
ALT = "coalesce(altitude_mean, 0)"
COPX = he(clip(f"(4.5 - CAST(0.08 AS DOUBLE) * {GEL} - CAST(0.0005 AS DOUBLE) * {ALT})", 1, 5), 2)
FEATURES = {
    "f7_hdd_confidence": ("interact_hdd_confiance", he("hdd_sum / m.hdd * (confiance_menages / 100)", 4)),
    "f8_cdd_industry": ("interact_cdd_ipi", he("cdd_sum / m.cdd * (ipi_hvac_c28 / 100)", 4)),
    "f9_confidence_building": ("interact_confiance_bat", he("(confiance_menages / 100) * (climat_affaires_bat / 100)", 4)),
    "f10_extreme_days": ("jours_extremes", "nb_jours_canicule + nb_jours_gel"),
    "f11_cop_proxy": ("cop_proxy", COPX),
    "f12_mountain_flag": ("is_mountain", f"CAST({ALT} > 800 OR coalesce(pct_zone_montagne, 0) > 50 AS INTEGER)"),
    "f13_viability_score": (
        "pac_viability_score",
        he(
            f"CAST(0.5 AS DOUBLE) * {clip(f'(({COPX} - 1) / 4)', 0, 1)} + CAST(0.3 AS DOUBLE) * {clip('(coalesce(pct_maisons, 50) / 100)', 0, 1)}"
            f" + CAST(0.2 AS DOUBLE) * (1 - {clip(f'({GEL} / m.gel)', 0, 1)})",
            4,
        ),
    ),
    "f14_altitude_frost": ("interact_altitude_frost", he(f"({ALT} / m.alt) * ({GEL} / m.gel)", 4)),
    "f15_houses_altitude": ("interact_maisons_altitude", he(f"(coalesce(pct_maisons, 50) / 100) * ({ALT} / m.alt)", 4)),
    "f16_mountain_density": (
        "interact_montagne_densite",
        he(f"(coalesce(pct_zone_montagne, 0) / 100) * (1 - {clip('(coalesce(densite_pop, 0) / m.dens)', 0, 1)})", 4),
    ),
    "f17_inefficient_share": (
        "pct_jours_pac_inefficient",
        he("CAST(coalesce(nb_jours_pac_inefficient, 0) AS DOUBLE) / 30 * 100", 1),
    ),
    "f18_cop_hdd": ("interact_cop_hdd", he(f"({COPX} / 5) * (hdd_sum / m.hdd)", 4)),
}


def _feature(name):
    def run(spark, sf):
        stored = B.stored_panel(spark, sf)
        scalars = P.scaling_maxima(stored)
        out = P.heat_pump_efficiency(P.interactions(stored, scalars), scalars)
        return out.select("date_id", "dept", name)

    return run


for _key, (_name, _sql) in FEATURES.items():
    query(_key, f"SELECT date_id, dept, {_sql} AS {_name} FROM v_panel, {MAXIMA}")(_feature(_name))


@query(
    "f19_display_labels",
    f"""SELECT f.date_id, f.dept, f.dept || ' — ' || coalesce(dept_name, f.dept) AS label, printf('%04d-%02d', f.date_id // 100, f.date_id % 100) AS period
FROM v_facts f LEFT JOIN v_geo g ON f.dept = g.dept""",
)
def f19(spark, sf):
    geo = F.broadcast(geo_dimension(spark).select("dept", "dept_name"))
    return B.facts(spark, sf).join(geo, "dept", "left").select(
        "date_id", "dept", E.code_label("dept", "dept_name").alias("label"), E.id_label("date_id").alias("period")
    )


@query(
    "f20_severity_bands",
    f"""WITH p AS (SELECT dept, {pct('count(*) FILTER (WHERE temperature_2m_mean IS NULL)', 'count(*)')} AS null_pct FROM v_wx_raw GROUP BY dept)
SELECT dept, null_pct, CASE WHEN null_pct > 50 THEN 'CRITICAL' WHEN null_pct > 5 THEN 'WARNING' WHEN null_pct > 0 THEN 'OK' ELSE 'CLEAN' END AS severity FROM p""",
)
def f20(spark, sf):
    nulls = B.wx_raw(spark, sf).groupBy("dept").agg(
        E.percentage(F.count_if(F.col("temperature_2m_mean").isNull()), F.count(F.lit(1))).alias("null_pct")
    )
    return nulls.withColumn("severity", E.severity_band("null_pct"))


@query(
    "f21_column_sources",
    """WITH u AS (UNPIVOT (SELECT CAST(temp_mean AS DOUBLE) AS temp_mean, CAST(nb_dpe_total AS DOUBLE) AS nb_dpe_total,
  CAST(revenu_median AS DOUBLE) AS revenu_median, CAST(ipi_hvac_c28 AS DOUBLE) AS ipi_hvac_c28,
  CAST(nb_logements_autorises AS DOUBLE) AS nb_logements_autorises, CAST(month AS DOUBLE) AS month FROM v_panel)
  ON COLUMNS(*) INTO NAME "column" VALUE v)
SELECT CASE "column" WHEN 'temp_mean' THEN 'Weather (Open-Meteo)' WHEN 'nb_dpe_total' THEN 'DPE (ADEME)' WHEN 'revenu_median' THEN 'INSEE (economic)'
  WHEN 'ipi_hvac_c28' THEN 'Eurostat (industry)' WHEN 'nb_logements_autorises' THEN 'SITADEL (construction)' ELSE 'Other / Identifier' END AS source,
  "column", count(v) AS n FROM u GROUP BY ALL""",
)
def f21(spark, sf):
    from retropanel.operators.quality import source_of

    names = ["temp_mean", "nb_dpe_total", "revenu_median", "ipi_hvac_c28", "nb_logements_autorises", "month"]
    long = unpivot_values(B.panel(spark, sf), [], names, "column", "v")
    return long.groupBy(source_of("column").alias("source"), "column").agg(F.count("v").alias("n"))


@query(
    "f22_nested_json",
    """SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
  CAST(max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS INTEGER) AS k_max FROM events GROUP BY event_type""",
)
def f22(spark, sf):
    k = F.from_json("props", "k int")["k"]
    return B.table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))


@query("f23_fingerprints", "SELECT doc_id, sha256(text) AS hash_sha256 FROM documents")
def f23(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("hash_sha256"))


@query(
    "f24_span_coverage",
    f"""SELECT c_nationkey, CAST(datediff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS span_days,
  {he("datediff('day', min(o_orderdate), max(o_orderdate)) / 30.44", 2)} AS span_months
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def f24(spark, sf):
    o, c = B.table(spark, sf, "orders"), B.table(spark, sf, "customer")
    span = F.datediff(F.max("o_orderdate"), F.min("o_orderdate"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(
        span.alias("span_days"), E.half_even(span / 30.44, 2).alias("span_months")
    )
