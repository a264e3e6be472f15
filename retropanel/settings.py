"""Business parameters of the market panel."""

from __future__ import annotations

from dataclasses import dataclass, field

# Thresholds, bounds, patterns and column lists that decide the results.
HEATWAVE_ABOVE = 35.0
FROST_BELOW = 0.0
PUMP_INEFFICIENT_BELOW = -7.0
DEGREE_DAY_BASE = 18.0
HEAT_PUMP_PATTERN = r"(?i)PAC |PAC$|pompe.*chaleur|thermodynamique"
MONTHLY_PERIOD = r"^\d{4}-\d{2}$"
VALID_LABELS = ("A", "B", "C", "D", "E", "F", "G")
HIGH_LABELS = ("A", "B")
HEATING_MONTHS = (1, 2, 3, 10, 11, 12)
COOLING_MONTHS = (6, 7, 8, 9)
WEATHER_BOUNDS = {
    "temperature_2m_max": (-30, 50),
    "temperature_2m_min": (-30, 50),
    "temperature_2m_mean": (-30, 50),
    "precipitation_sum": (0, 300),
    "wind_speed_10m_max": (0, 200),
}
CERTIFICATE_BOUNDS = {
    "surface_habitable_logement": (5, 1000),
    "conso_5_usages_par_m2_ep": (0, 1000),
    "conso_5_usages_par_m2_ef": (0, 1000),
    "emission_ges_5_usages_par_m2": (0, 500),
    "cout_total_5_usages": (0, 50000),
    "cout_chauffage": (0, 30000),
    "cout_ecs": (0, 10000),
    "hauteur_sous_plafond": (1.5, 8.0),
}
ECONOMY_NAMES = {
    "confiance_menages": "confiance_menages",
    "climat_affaires_industrie": "climat_affaires_indus",
    "climat_affaires_batiment": "climat_affaires_bat",
    "opinion_achats_importants": "opinion_achats",
    "situation_financiere_future": "situation_fin_future",
    "ipi_industrie_manuf": "ipi_manufacturing",
}
INDUSTRY_NAMES = {"C28": "ipi_hvac_c28", "C2825": "ipi_hvac_c2825"}
PERMIT_NAMES = {
    "NB_LGT_TOT_CREES": "nb_logements_autorises",
    "NB_LGT_IND_CREES": "nb_logements_individuels",
    "NB_LGT_COLL_CREES": "nb_logements_collectifs",
    "SURF_TOT_M2": "surface_autorisee_m2",
}
PERMIT_ALIASES = {
    "DEP_CODE": "DEP",
    "REG_CODE": "REG",
    "DATE_REELLE_AUTORISATION": "DATE_PRISE_EN_COMPTE",
    "NB_LGT_COL_CREES": "NB_LGT_COLL_CREES",
    "SURF_HAB_CREEE": "SURF_TOT_M2",
}
COUNT_COLUMNS = (
    "nb_dpe_total",
    "nb_installations_pac",
    "nb_installations_clim",
    "nb_dpe_classe_ab",
)
RATE_COLUMNS = ("pac_per_1000_logements", "clim_per_1000_logements")
LAG_COLUMNS = (
    "nb_dpe_total",
    "nb_installations_pac",
    "nb_installations_clim",
    "pac_per_1000_logements",
    "clim_per_1000_logements",
    "nb_dpe_classe_ab",
    "temp_mean",
    "hdd_sum",
    "cdd_sum",
    "confiance_menages",
)
ROLLING_COLUMNS = (
    "nb_dpe_total",
    "nb_installations_pac",
    "pac_per_1000_logements",
    "temp_mean",
    "hdd_sum",
    "cdd_sum",
    "nb_dpe_classe_ab",
)
VARIATION_COLUMNS = (
    "nb_dpe_total",
    "nb_installations_pac",
    "nb_installations_clim",
    "pac_per_1000_logements",
    "clim_per_1000_logements",
)
NON_FEATURES = (
    "date_id",
    "dept",
    "dept_name",
    "city_ref",
    "latitude",
    "longitude",
    "year",
    "month",
    "quarter",
)
RIDGE_ALPHAS = (0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0)
SEASONAL_WORDS = ("temp", "precip", "wind", "hdd", "cdd", "canicule", "gel", "pac_ineff", "delta_temp")


@dataclass(frozen=True)
class PanelSettings:
    """What one run may change."""

    certificate_start: str = "2021-07-01"
    as_of: str = "2026-02-28"
    train_end: int = 202406
    val_end: int = 202412
    lags: tuple[int, ...] = (1, 3, 6)
    max_lag: int = 6
    windows: tuple[int, ...] = (3, 6)
    skip_rules: dict[str, set[str]] = field(default_factory=dict)

    @property
    def active_lags(self) -> tuple[int, ...]:
        return tuple(k for k in self.lags if k <= self.max_lag)
