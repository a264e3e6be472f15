"""The flagship and the stages of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel.operators import cleaning as C
from retropanel.operators import windows as W
from retropanel.plans import panel as P
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import change, clip, he
from retropanel.sources.dimensions import geo_dimension


@query(
    "flagship_panel_momentum",
    f"""
SELECT f.date_id, f.dept, g.dept_name, nb_dpe_total, nb_installations_pac, pct_pac, pct_clim,
  lag(nb_installations_pac) OVER w AS nb_installations_pac_lag_1m,
  {he('avg(nb_installations_pac) OVER (PARTITION BY f.dept ORDER BY f.date_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS nb_installations_pac_rmean_3m,
  {clip(he(change('nb_installations_pac', 'lag(nb_installations_pac) OVER w'), 2), -200, 500)} AS nb_installations_pac_pct_1m,
  CAST(rank() OVER (PARTITION BY f.date_id ORDER BY nb_installations_pac DESC) AS INTEGER) AS rank_pac
FROM v_facts f LEFT JOIN v_geo g ON f.dept = g.dept
WINDOW w AS (PARTITION BY f.dept ORDER BY f.date_id)""",
)
def flagship(spark, sf):
    facts = B.facts(spark, sf)
    geo = geo_dimension(spark).select("dept", "dept_name")
    w = W.by_entity()
    c = ["nb_installations_pac"]
    out = facts.join(F.broadcast(geo), "dept", "left").withColumns(
        W.lag_columns(c, [1], w) | W.rolling_means(c, [3], w) | W.pct_changes(c, w)
    )
    ranked = W.rank_in_period(out, "nb_installations_pac", name="rank_pac")
    return ranked.select(
        "date_id", "dept", "dept_name", "nb_dpe_total", "nb_installations_pac", "pct_pac", "pct_clim",
        "nb_installations_pac_lag_1m", "nb_installations_pac_rmean_3m", "nb_installations_pac_pct_1m", "rank_pac",
    )


@query("stage_clean_certificates", "SELECT * FROM v_cert")
def clean_certificates(spark, sf):
    return B.cert(spark, sf, frozenset())


@query("stage_clean_weather", "SELECT * FROM v_wx")
def clean_weather(spark, sf):
    return B.wx(spark, sf)


@query("stage_clean_series", "SELECT * FROM v_eco")
def clean_series(spark, sf):
    return C.clean_series(B.eco_raw(spark, sf), ["batch_no"]).drop("batch_no")


@query("stage_clean_industry", "SELECT * FROM v_ind")
def clean_industry(spark, sf):
    return C.clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat").drop("batch_no")


@query("stage_economic_features", "SELECT * FROM v_eco_wide")
def economic(spark, sf):
    wide = C.clean_series(B.eco_raw(spark, sf), ["batch_no"])
    industry = C.clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat")
    return P.economic_features(P.wide_series(wide), P.industry_series(industry))


@query("stage_permit_features", "SELECT * FROM v_permit")
def permits(spark, sf):
    return P.permit_features(B.permit_raw(spark, sf))


@query("stage_area_attributes", "SELECT * FROM v_attr")
def attributes(spark, sf):
    return P.area_attributes(B.attr_raw(spark, sf), geo_dimension(spark))


@query("stage_panel", "SELECT * FROM v_panel")
def panel(spark, sf):
    return B.panel(spark, sf)
