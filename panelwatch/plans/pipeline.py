"""The three jobs: weekly data, training, and scoring of a week."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions.calendar import parse_week
from panelwatch.operators.metrics import best_candidate, promotion
from panelwatch.operators.panel import (
    assert_not_proxy,
    assert_quality,
    enrich_panel,
    latest_week,
    panel_grid,
    pseudo_absences,
    quality_gate,
)
from panelwatch.operators.spatial import geocode, point_in_polygon
from panelwatch.operators.timeseries import weekly_rain_features, weekly_soil_features
from panelwatch.plans.models import FAMILIES, Fitted, cv_summary, full_grid_eval, panel_cv
from panelwatch.session import scratch_folder
from panelwatch.settings import RAIN_FEATURES, Settings
from panelwatch.sources.landing import regional_events
from panelwatch.sources.sinks import predictions, week_documents, write_panel


def place_events(
    raw_events: DataFrame,
    places: DataFrame,
    polygons: DataFrame,
    department: str,
    keywords: Sequence[str],
    settings: Settings = Settings(),
    row_id: str = "id",
) -> DataFrame:
    """Raw reports to events in units: filter, geocode by name, then point in polygon."""
    chosen = regional_events(
        raw_events, department, keywords, settings.first_year, settings.last_year
    )
    located = geocode(chosen, places, "municipio")
    return point_in_polygon(located, polygons)


def build_panels(
    events: DataFrame,
    units: DataFrame,
    daily_rain: DataFrame,
    first: Column,
    last: Column,
    daily_soil: DataFrame | None = None,
    settings: Settings = Settings(),
) -> tuple[DataFrame, DataFrame]:
    """(full panel, training panel). The training rows are chosen from the enriched panel."""
    rain = weekly_rain_features(daily_rain)
    soil = weekly_soil_features(daily_soil) if daily_soil is not None else None
    full = enrich_panel(panel_grid(units, events, first, last), units, rain, soil)
    return full, pseudo_absences(full, rain, units, settings)


def run_data_job(
    events: DataFrame,
    units: DataFrame,
    daily_rain: DataFrame,
    folder: str,
    settings: Settings = Settings(),
) -> None:
    """Builds, checks and stores both panels. Raises when a check fails."""
    first = F.lit(f"{settings.first_year}-01-01").cast("date")
    last = F.lit(f"{settings.last_year}-12-31").cast("date")
    assert_not_proxy(weekly_rain_features(daily_rain))
    full, chosen = build_panels(events, units, daily_rain, first, last, settings=settings)
    write_panel(full, f"{folder}/full")
    write_panel(chosen, f"{folder}/training")
    stored = events.sparkSession.read.parquet(f"{folder}/training")
    years = settings.last_year - settings.first_year + 1
    assert_quality(quality_gate(stored, RAIN_FEATURES, settings, years))


def store_panels(
    full: DataFrame, training: DataFrame | Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Both panels written once to the shared folder and read back.

    Model fitting passes over the panel many times; reading stored files again is
    cheaper than recomputing it and survives the loss of executors. ``training`` may say how
    its rows are chosen from the stored panel, which is then not computed a second time.
    """
    spark = full.sparkSession
    folder = scratch_folder(spark, "panels")
    read = lambda name: spark.read.parquet(f"{folder}/{name}").drop("year", "anio_semana")
    write_panel(full, f"{folder}/full")
    write_panel(training(read("full")) if callable(training) else training, f"{folder}/training")
    return read("full"), read("training")


def training_report(
    train: DataFrame,
    full: DataFrame,
    families: dict[str, dict] | None = None,
    train_until: int | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Cross-validation and unfiltered-grid metrics of every family, with promotion verdicts.

    ``families`` maps a family to its parameters; by default all, with published ones.
    """
    first = None if train_until is None else train_until + 1
    rows = []
    for name, params in (families or dict.fromkeys(FAMILIES, {})).items():
        label = F.lit(name).alias("modelo")
        cv = cv_summary(panel_cv(train, name, settings.folds, **params)).select(label, "*")
        grid = full_grid_eval(train, full, name, train_until, first, **params).select(label, "*")
        rows.append(cv.join(grid, "modelo"))
    return promotion(reduce(DataFrame.unionByName, rows), settings)


def pick_model(report: DataFrame) -> str:
    return best_candidate(report, "auc_roc_full", ("baseline_dummy",)).first()["modelo"]


def historic_week(cells: DataFrame, label: str) -> DataFrame:
    """Rows of one stored week, named ``2021-01-04/2021-01-10`` or by any of its days."""
    return cells.where(F.col("week_start") == parse_week(F.lit(label)))


def score_week(
    fitted: Fitted, full: DataFrame, stamp: Column, label: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(published rows, document) of the latest or of a named week."""
    week = latest_week(full) if label is None else historic_week(full, label)
    published = predictions(fitted.score(week), stamp)
    return published, week_documents(published, fitted.features)


def read_stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{n}") for n in ("full", "training"))
