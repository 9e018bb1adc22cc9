"""The dense (week x unit) panel: grid, features, labels, negatives, quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwatch.functions.calendar import seasonality, week_label, week_start, week_year
from panelwatch.operators.ordering import exact_quantiles, shuffle_partitions
from panelwatch.settings import RAIN_FEATURES, SOIL_FEATURE, TARGET, Settings


def event_counts(events: DataFrame, keys: Sequence[str] = ("unit_id",), day: str = "fecha"):
    return events.groupBy(*keys, week_start(F.col(day)).alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_eventos")
    )


def week_list(first: Column, last: Column) -> Column:
    """All weeks between two days, as an array."""
    return F.sequence(week_start(first), week_start(last), F.expr("interval 7 days"))


def panel_grid(units: DataFrame, events: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every week of every unit with its number of events and a 0/1 label.

    The weeks are exploded from each unit row, so no cartesian join is planned, and
    a unit's counts are attached to its row (a map with one entry per week at most)
    before it multiplies, so nothing as large as the panel is shuffled. The units are spread
    over a fixed number of partitions: they are few bytes until then, and adaptive
    coalescing would otherwise leave the whole panel to one task.
    """
    wide = shuffle_partitions(units)
    history = (
        event_counts(events)
        .groupBy("unit_id")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("week_start", "n_eventos"))).alias("_history")
        )
    )
    n = F.coalesce(F.try_element_at("_history", F.col("week_start")), F.lit(0)).cast("bigint")
    return (
        units.select("unit_id")
        .repartition(wide, "unit_id")
        .distinct()
        .join(history, "unit_id", "left")
        .select("unit_id", "_history", F.explode(week_list(first, last)).alias("week_start"))
        .select("week_start", "unit_id", n.alias("n_eventos"))
        .withColumn(TARGET, (F.col("n_eventos") > 0).cast("int"))
    )


def enrich_panel(
    cells: DataFrame,
    units: DataFrame,
    rain: DataFrame,
    soil: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Adds static attributes, weekly features and seasonality (month of the Monday).

    With no ``keys`` the weekly features describe the whole region, one row per
    week, which bounds their size by the calendar: these are broadcast. Features of
    single units join on (unit, week) as Spark sees fit.
    """
    on = [*keys, "week_start"]
    weekly = rain.select(*on, *RAIN_FEATURES)
    if soil is not None:
        weekly = weekly.join(soil.select(*on, SOIL_FEATURE), on, "left")
    if not keys:
        weekly = F.broadcast(weekly)
    return (
        cells.join(units, "unit_id", "left")
        .join(weekly, on, "left")
        .select(
            *cells.columns,
            *[c for c in units.columns if c != "unit_id"],
            *seasonality(F.col("week_start"), F.col("week_start")),
            *[c for c in weekly.columns if c not in on],
        )
    )


def circular_proxy(weekly: DataFrame, value: str, strict_nulls: bool = False) -> DataFrame:
    """One row telling whether a rain column looks like event counts.

    It does when every value is a whole number and the largest is below 20. A null
    counts as not whole, as in the published rule; ``strict_nulls`` ignores nulls.
    """
    whole = F.col(value) % 1 == 0
    verdict = whole if strict_nulls else F.coalesce(whole, F.lit(False))
    return weekly.agg(
        F.coalesce(F.bool_and(verdict), F.lit(True)).alias("all_whole"),
        F.max(value).alias("max_value"),
    ).select(
        "all_whole",
        "max_value",
        F.coalesce(F.col("all_whole") & (F.col("max_value") < 20), F.lit(False)).alias(
            "is_proxy"
        ),
    )


def assert_not_proxy(weekly: DataFrame, value: str = "precip_acum_14d") -> None:
    """Stops a pipeline whose rain feature is a disguised label."""
    row = circular_proxy(weekly, value).first()
    if row["is_proxy"]:
        raise ValueError(
            f"{value} looks like event counts (max {row['max_value']}), not millimetres"
        )


def pseudo_absences(
    cells: DataFrame,
    weekly: DataFrame,
    units: DataFrame,
    settings: Settings = Settings(),
    value: str = "precip_acum_14d",
) -> DataFrame:
    """All positives, plus negatives of dry weeks in units with little drainage area.

    ``weekly`` is the regional series, one row per week of the calendar: small enough
    for the built-in exact percentile and for a broadcast, which units need not be.
    """
    rain_cut = weekly.agg(F.percentile(value, F.lit(settings.rain_percentile))).scalar()
    area_cut = exact_quantiles(units, "up_area", {"q": settings.area_percentile}).scalar()
    dry = F.broadcast(
        weekly.where(F.col(value) <= rain_cut).select("week_start", F.lit(True).alias("_dry"))
    )
    stable = units.where(F.col("up_area") <= area_cut).select(
        "unit_id", F.lit(True).alias("_stable")
    )
    flagged = cells.join(dry, "week_start", "left").join(stable, "unit_id", "left")
    negative = F.col("_dry") & F.col("_stable")
    return flagged.where((F.col(TARGET) == 1) | ((F.col(TARGET) == 0) & negative)).select(
        *cells.columns
    )


def quality_gate(
    cells: DataFrame, features: Sequence[str], settings: Settings, years: int
) -> DataFrame:
    """Checks of a training panel as one row; ``ok`` is false when any fails."""
    wrong = F.count_if(F.coalesce(~F.col(TARGET).isin(0, 1), F.lit(True)))
    row = cells.agg(
        F.sum(TARGET).cast("bigint").alias("n_pos"),
        F.count_distinct("week_start").alias("n_weeks"),
        wrong.alias("n_invalid"),
        *[F.count(f).alias(f"_n_{f}") for f in features],
    )
    empty = F.concat_ws(",", *[F.when(F.col(f"_n_{f}") == 0, F.lit(f)) for f in features])
    coverage = F.col("n_weeks") / F.lit(52.0 * years)
    return row.select("n_pos", "n_weeks", coverage.alias("coverage"), "n_invalid",
                      empty.alias("null_features")).withColumn(
        "ok",
        (F.col("n_pos") >= settings.min_positives)
        & (F.col("coverage") >= settings.min_coverage)
        & (F.col("n_invalid") == 0)
        & (F.col("null_features") == ""),
    )


def assert_quality(gate: DataFrame) -> None:
    row = gate.first()
    if not row["ok"]:
        raise ValueError(f"data quality gate failed: {row.asDict()}")


def weekly_dataset(rain: DataFrame, soil: DataFrame, events: DataFrame) -> DataFrame:
    """Regional weeks: rain, then soil, then event counts (0 where none)."""
    counts = event_counts(events, keys=()).withColumnRenamed("n_eventos", "n_deslizamientos")
    return (
        rain.join(soil.select("week_start", SOIL_FEATURE), "week_start", "left")
        .join(counts, "week_start", "left")
        .withColumn("n_deslizamientos", F.coalesce("n_deslizamientos", F.lit(0)).cast("bigint"))
    )


def next_week_target(weekly: DataFrame, parity: bool = False) -> DataFrame:
    """Label of a week: does the following one have an event? Unknown for the last week.

    ``parity`` gives the last week 0, as the published job does.
    """
    following = F.lead("n_deslizamientos").over(Window.orderBy("week_start")) > 0
    label = following.cast("int")
    return weekly.withColumn(TARGET, F.coalesce(label, F.lit(0)) if parity else label)


def weekly_training_set(
    rain: DataFrame, soil: DataFrame, events: DataFrame, first_year: int, last_year: int
) -> DataFrame:
    """The regional dataset to its end: label of the next week, the period, no null features."""
    labelled = next_week_target(weekly_dataset(rain, soil, events))
    return year_slice(labelled, first_year, last_year).na.drop(
        subset=[*RAIN_FEATURES, SOIL_FEATURE, TARGET]
    )


def target_by_unit(cells: DataFrame, calendar: bool = False) -> DataFrame:
    """Label of the next retained row of the same unit; rows without one are dropped.

    With ``calendar`` the next row must also be the next week.
    """
    ordered = Window.partitionBy("unit_id").orderBy("week_start")
    label = F.lead(TARGET).over(ordered)
    if calendar:
        adjacent = F.lead("week_start").over(ordered) == F.date_add("week_start", 7)
        label = F.when(adjacent, label)
    labelled = cells.withColumn("_next", label).where(F.col("_next").isNotNull())
    return labelled.drop(TARGET, "n_eventos").withColumnRenamed("_next", TARGET)


def year_slice(
    cells: DataFrame, first: int | None = None, last: int | None = None, anchor: str = "start"
) -> DataFrame:
    """Weeks of the given years. A range on the date itself, so that partitions can be pruned."""
    shift = 0 if anchor == "start" else 6
    if first is not None:
        cells = cells.where(F.col("week_start") >= F.date_sub(F.lit(f"{first}-01-01").cast("date"), shift))
    if last is not None:
        cells = cells.where(F.col("week_start") < F.date_sub(F.lit(f"{last + 1}-01-01").cast("date"), shift))
    return cells


def latest_week(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("week_start") == cells.agg(F.max("week_start")).scalar())


def available_weeks(cells: DataFrame) -> DataFrame:
    return (
        cells.select("week_start")
        .distinct()
        .select("week_start", week_label(F.col("week_start")).alias("semana"))
        .orderBy("week_start")
    )


def class_balance(cells: DataFrame) -> DataFrame:
    positives, rows = F.sum(TARGET), F.count(TARGET)
    return cells.agg(rows.alias("n"), positives.cast("bigint").alias("n_pos")).select(
        "n",
        "n_pos",
        (F.col("n") - F.col("n_pos")).alias("n_neg"),
        (100.0 * F.col("n_pos") / F.col("n")).alias("pct_pos"),
        F.try_divide((F.col("n") - F.col("n_pos")).cast("double"), F.col("n_pos").cast("double")).alias("ratio"),
    )


def class_weights(cells: DataFrame) -> DataFrame:
    """Balanced weight of each class: rows / (2 * rows of the class)."""
    counts = cells.groupBy(F.col(TARGET).alias("clase")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # two rows
    return counts.select("clase", "n", (total / (2.0 * F.col("n"))).alias("peso"))


def null_profile(cells: DataFrame, features: Sequence[str]) -> DataFrame:
    """Nulls of each feature, count and percent, from one pass."""
    row = cells.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f).isNull()).alias(f) for f in features]
    )
    return row.unpivot(["_n"], list(features), "feature", "n_missing").select(
        "feature", "n_missing", (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct")
    )


def unpivot_features(cells: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    doubles = cells.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return doubles.unpivot(list(ids), list(features), "feature", "value").where(
        F.col("value").isNotNull()
    )


def feature_summary(cells: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of each feature."""
    long = unpivot_features(cells, features)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["feature"])
    return moments.join(quartiles, "feature")


def low_coverage(weekly: DataFrame, value: str, percentile: float = 0.25) -> DataFrame:
    """Weeks of the calendar whose sensor coverage lies below the given percentile of them."""
    cut = weekly.agg(F.percentile(value, F.lit(percentile))).scalar()
    return weekly.withColumn("umbral", cut).where(F.col(value) < F.col("umbral"))


def inactive_units(units: DataFrame, events: DataFrame) -> DataFrame:
    return units.join(events.select("unit_id").distinct(), "unit_id", "left_anti")


def active_unit_areas(units: DataFrame, events: DataFrame) -> DataFrame:
    """Number and exact median area of units with and without events."""
    seen = events.select("unit_id").distinct().withColumn("_hit", F.lit(True))
    marked = units.join(seen, "unit_id", "left").select(
        F.coalesce("_hit", F.lit(False)).alias("activa"), "sub_area"
    )
    counts = marked.groupBy("activa").agg(F.count(F.lit(1)).alias("n_unidades"))
    return counts.join(exact_quantiles(marked, "sub_area", {"mediana_area": 0.5}, ["activa"]), "activa")


def panel_years(cells: DataFrame) -> DataFrame:
    """Adds the partition column of the stored panel."""
    return cells.withColumn("year", week_year(F.col("week_start")))
