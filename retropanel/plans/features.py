"""Engineered features over the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import windows as W
from retropanel.operators.aggregates import completeness

Scalars = dict[str, float | int | None]


def series_features(
    panel: DataFrame, cfg: S.PanelSettings = S.PanelSettings(), shift_target_windows: bool = False
) -> DataFrame:
    """Lags, rolling statistics and changes over one shared window: one shuffle, one sort.

    ``shift_target_windows`` ends rolling windows and differences of the certificate counts one month
    earlier, which keeps the month to predict out of its own inputs.
    """
    w = W.by_entity()
    has = lambda names: E.present(panel, names)
    targets = set(S.COUNT_COLUMNS) | set(S.RATE_COLUMNS)
    own = lambda names: [c for c in names if c in targets and shift_target_windows]
    rest = lambda names: [c for c in names if not (c in targets and shift_target_windows)]
    rolling, varying = has(S.ROLLING_COLUMNS), has(S.VARIATION_COLUMNS)
    plan: dict[str, Column] = W.lag_columns(has(S.LAG_COLUMNS), cfg.active_lags, w)
    for shift, roll, vary in ((False, rest(rolling), rest(varying)), (True, own(rolling), own(varying))):
        plan |= W.rolling_means(roll, cfg.windows, w, shift)
        plan |= W.rolling_stds(roll, cfg.windows, w, shift)
        plan |= W.differences(vary, w, shift)
    plan |= W.pct_changes(varying, w)
    out = panel.withColumns(plan)
    if shift_target_windows:
        out = out.withColumns({f"{c}_pct_1m": F.lag(f"{c}_pct_1m").over(w) for c in varying})
    return out


def _scaled(c: str, scalars: Scalars) -> Column:
    """Value over the larger of the table maximum and 1."""
    return F.col(c) / F.lit(max(scalars[c] or 0.0, 1.0))


def scaling_maxima(panel: DataFrame) -> Scalars:
    """Table-wide maxima (and first year) of the scaled columns: one aggregate row."""
    names = E.present(
        panel, ("hdd_sum", "cdd_sum", "nb_jours_gel", "altitude_mean", "altitude", "densite_pop")
    )
    aggs = {c: F.max(F.col(c).cast("double")) for c in names}
    if "year" in panel.columns:
        aggs["year"] = F.min("year")
    return panel.agg(*[a.alias(c) for c, a in aggs.items()]).first().asDict() if aggs else {}


def interactions(panel: DataFrame, scalars: Scalars) -> DataFrame:
    have = set(panel.columns)
    plan: dict[str, Column] = {}
    if {"hdd_sum", "confiance_menages"} <= have:
        plan["interact_hdd_confiance"] = E.half_even(
            _scaled("hdd_sum", scalars) * (F.col("confiance_menages") / 100.0), 4
        )
    if {"cdd_sum", "ipi_hvac_c28"} <= have:
        plan["interact_cdd_ipi"] = E.half_even(
            _scaled("cdd_sum", scalars) * (F.col("ipi_hvac_c28") / 100.0), 4
        )
    if {"confiance_menages", "climat_affaires_bat"} <= have:
        plan["interact_confiance_bat"] = E.half_even(
            (F.col("confiance_menages") / 100.0) * (F.col("climat_affaires_bat") / 100.0), 4
        )
    if {"nb_jours_canicule", "nb_jours_gel"} <= have:
        plan["jours_extremes"] = F.col("nb_jours_canicule") + F.col("nb_jours_gel")
    return panel.withColumns(plan)


def heat_pump_efficiency(panel: DataFrame, scalars: Scalars) -> DataFrame:
    """Efficiency proxy, mountain flag, viability score and their interactions, per present column."""
    have = set(panel.columns)
    alt = E.first_present(panel, ("altitude_mean", "altitude"))
    frost = "nb_jours_gel" in have
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    ratio = lambda c: zero(c) / F.lit(max(scalars[c] or 0.0, 1.0))
    plan: dict[str, Column] = {}
    if alt or frost:
        cop = F.lit(4.5)
        if frost:
            cop = cop - F.lit(0.08) * zero("nb_jours_gel")
        if alt:
            cop = cop - F.lit(0.0005) * zero(alt)
        plan["cop_proxy"] = E.half_even(E.clip(cop, 1.0, 5.0), 2)
    if alt or "pct_zone_montagne" in have:
        high = F.lit(False)
        if alt:
            high = high | (zero(alt) > 800)
        if "pct_zone_montagne" in have:
            high = high | (zero("pct_zone_montagne") > 50)
        plan["is_mountain"] = high.cast("int")
    out = panel.withColumns(plan)
    more: dict[str, Column] = {}
    if "cop_proxy" in plan:
        cop_norm = E.clip((F.col("cop_proxy") - 1.0) / 4.0, 0.0, 1.0)
        houses = F.lit(0.5)
        if "pct_maisons" in have:
            houses = E.clip(F.coalesce("pct_maisons", F.lit(50.0)) / 100.0, 0.0, 1.0)
        penalty = 1.0 - E.clip(ratio("nb_jours_gel"), 0.0, 1.0) if frost else F.lit(0.5)
        more["pac_viability_score"] = E.half_even(
            F.lit(0.5) * cop_norm + F.lit(0.3) * houses + F.lit(0.2) * penalty, 4
        )
        if "hdd_sum" in have:
            more["interact_cop_hdd"] = E.half_even(
                (F.col("cop_proxy") / 5.0) * _scaled("hdd_sum", scalars), 4
            )
    if alt and frost:
        more["interact_altitude_frost"] = E.half_even(ratio(alt) * ratio("nb_jours_gel"), 4)
    if alt and "pct_maisons" in have:
        more["interact_maisons_altitude"] = E.half_even(
            (F.coalesce("pct_maisons", F.lit(50.0)) / 100.0) * ratio(alt), 4
        )
    if {"pct_zone_montagne", "densite_pop"} <= have:
        sparse = 1.0 - E.clip(ratio("densite_pop"), 0.0, 1.0)
        more["interact_montagne_densite"] = E.half_even(
            (zero("pct_zone_montagne") / 100.0) * sparse, 4
        )
    if "nb_jours_pac_inefficient" in have:
        more["pct_jours_pac_inefficient"] = E.half_even(
            zero("nb_jours_pac_inefficient") / 30.0 * 100.0, 1
        )
    return out.withColumns(more)


def trends(panel: DataFrame, scalars: Scalars) -> DataFrame:
    plan: dict[str, Column] = {}
    if "year" in panel.columns:
        plan["year_trend"] = F.col("year") - F.lit(scalars["year"])
    if {"temp_mean", "dept", "month"} <= set(panel.columns):
        usual = F.avg("temp_mean").over(Window.partitionBy("dept", "month"))
        plan["delta_temp_vs_mean"] = E.half_even(F.col("temp_mean") - usual, 2)
    return panel.withColumns(plan)


def engineer(
    panel: DataFrame, cfg: S.PanelSettings = S.PanelSettings(), shift_target_windows: bool = False
) -> DataFrame:
    """All features of a stored panel; pass a materialised frame, since maxima read it as well."""
    scalars = scaling_maxima(panel)
    out = series_features(panel, cfg, shift_target_windows)
    out = interactions(out, scalars)
    out = heat_pump_efficiency(out, scalars)
    return completeness(trends(out, scalars))
