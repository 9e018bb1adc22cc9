"""Parameters of the weekly early-warning job, as plain immutable objects."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must equal the published ones for results to agree.
HYDRO_KEYWORDS = (
    "avenida torrencial",
    "creciente subita",
    "inundacion",
    "deslizamiento",
    "derrumbe",
    "movimiento en masa",
    "flujo de lodo",
)

RAIN_FEATURES = (
    "precip_acum_14d",
    "precip_acum_7d",
    "precip_acum_3d",
    "precip_max_diario_14d",
    "precip_dias_lluvia_14d",
)
SOIL_FEATURE = "soil_moisture_14d"
STATIC_FEATURES = ("sub_area", "up_area", "dist_main", "ord")
SEASON_FEATURES = ("semana_sin", "semana_cos", "mes_sin", "mes_cos")
MODEL_FEATURES = RAIN_FEATURES + STATIC_FEATURES + (SOIL_FEATURE,) + SEASON_FEATURES
TARGET = "deslizamiento"

# Consequence columns and the words by which raw column names are recognised.
CONSEQUENCE_SYNONYMS = {
    "fallecidos": ("fallecidos", "muertos", "muertes"),
    "heridos": ("heridos", "lesionados"),
    "desaparecidos": ("desaparecidos",),
    "personas": ("personas", "afectadas", "damnificadas"),
    "familias": ("familias",),
    "viviendas_destruidas": ("destruidas", "destruidas_total"),
    "viviendas_averiadas": ("averiadas", "afectadas_viv"),
}
CONSEQUENCES = tuple(CONSEQUENCE_SYNONYMS)

# Reference unit prices in COP.
UNIT_PRICE_COP = {
    "fallecidos": 760_000_000,
    "heridos": 87_500_000,
    "desaparecidos": 380_000_000,
    "personas": 700_000,
    "familias": 0,
    "viviendas_destruidas": 60_000_000,
    "viviendas_averiadas": 12_000_000,
}
COP_PER_USD = 4_100
DEFAULT_DENSITY_PER_KM2 = 120


@dataclass(frozen=True)
class Economics:
    system_cost: float = 200_000_000.0  # four years at 50 M
    false_alarm_cost: float = 5_000_000.0
    reductions: tuple[float, ...] = (0.40, 0.50, 0.60, 0.70, 0.80, 0.90)
    alert_sizes: tuple[int, ...] = (10, 20, 50, 91, 100, 150, 200)


@dataclass(frozen=True)
class Settings:
    first_year: int = 2019
    last_year: int = 2022
    rain_percentile: float = 0.25
    area_percentile: float = 0.25
    folds: int = 4
    min_positives: int = 50
    min_coverage: float = 0.80
    low_band: float = 0.30
    high_band: float = 0.60
    promote_auc: float = 0.60
    promote_precision: float = 0.006
    drift_alpha: float = 0.05
    drift_min_rows: int = 10
    logistic_c: float = 0.57
    forest_trees: int = 183
    forest_depth: int = 6
    forest_min_leaf: int = 2
    pu_bags: int = 19
    pu_depth: int = 5
    economics: Economics = field(default_factory=Economics)
