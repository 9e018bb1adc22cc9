"""Daily series to leakage-safe weekly features.

Rolling sums are not computed over a filled daily calendar. Days are first folded
into one row per (series, week) carrying seven daily slots - an aggregation with
map-side partial sums, so a hot series is reduced before it is shuffled. The
windows that follow run over weeks, of which a series has as many as its time
span, whatever the number of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.functions.calendar import seasonality, week_start
from panelwatch.operators.ordering import shuffle_partitions
from panelwatch.settings import RAIN_FEATURES, SOIL_FEATURE

# Window length in days and the least number of days that must be present.
ROLLING_SUMS = {"precip_acum_14d": (14, 7), "precip_acum_7d": (7, 4), "precip_acum_3d": (3, 2)}
WET_WINDOW, WET_MINIMUM = 14, 7
#: Least number of tasks among which series are dealt before their days are generated.
SERIES_TASKS = 512


def _by_series(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys)


def week_slots(
    daily: DataFrame, keys: Sequence[str], day: str, value: str, counts: bool = False
) -> DataFrame:
    """One row per (series, week) from first to last week: slots, first and last day.

    ``slots`` holds the seven daily totals, Monday first; days without data are 0.
    Weeks without data are generated from the gap to the next week present, so no
    calendar join is needed.
    """
    keys = list(keys)
    at = F.weekday(F.col(day))
    aggregates = [
        F.coalesce(F.sum(F.when(at == i, F.col(value))), F.lit(0.0)).alias(f"_d{i}")
        for i in range(7)
    ] + [F.min(day).alias("_min"), F.max(day).alias("_max")]
    if counts:
        aggregates.append(F.count(value).alias("_readings"))
    weeks = (
        daily.where(F.col(day).isNotNull())
        .groupBy(*keys, week_start(F.col(day)).alias("week_start"))
        .agg(*aggregates)
    )
    ordered = _by_series(keys).orderBy("week_start")
    # The whole frame, in the same order: one sort serves all three expressions.
    series = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.lead("week_start").over(ordered)
    present = weeks.select(
        *keys,
        "week_start",
        F.array(*[f"_d{i}" for i in range(7)]).alias("_slots"),
        *(["_readings"] if counts else []),
        F.min("_min").over(series).alias("first_day"),
        F.max("_max").over(series).alias("last_day"),
        F.coalesce(F.date_sub(following, 7), F.col("week_start")).alias("_until"),
    )
    seven_days = F.expr("interval 7 days")
    dense = present.withColumn(
        "_week", F.explode(F.sequence("week_start", "_until", seven_days))
    )
    own = F.col("_week") == F.col("week_start")
    empty = F.array(*[F.lit(0.0)] * 7)
    return dense.select(
        *keys,
        F.col("_week").alias("week_start"),
        F.when(own, F.col("_slots")).otherwise(empty).alias("slots"),
        *([F.when(own, F.col("_readings")).otherwise(0).alias("readings")] if counts else []),
        "first_day",
        "last_day",
    )


def _window_at_week_end(slots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the three weeks of slots up to each week and the position of its last day."""
    ordered = _by_series(keys).orderBy("week_start")
    empty = F.array(*[F.lit(0.0)] * 7)
    three = F.concat(
        F.coalesce(F.lag("slots", 2).over(ordered), empty),
        F.coalesce(F.lag("slots", 1).over(ordered), empty),
        F.col("slots"),
    )
    week_last = F.least(F.date_add("week_start", 6), F.col("last_day"))
    return slots.select(
        "*",
        three.alias("_three"),
        week_last.alias("fecha_fin_semana"),
        (F.datediff(week_last, F.col("week_start")) + 15).alias("_stop"),  # 1-based, inclusive
        (F.datediff(week_last, F.col("first_day")) + 1).alias("_age"),
    )


def _last_days(n: int) -> list[Column]:
    """The n days up to the end of the week, as plain element reads (compiled, no lambdas)."""
    return [F.get("_three", F.col("_stop") - i) for i in range(1, n + 1)]


def _total(values: list[Column]) -> Column:
    return reduce(add, reversed(values))


def weekly_rain_features(
    daily: DataFrame,
    keys: Sequence[str] = (),
    day: str = "fecha",
    value: str = "precip_mm",
    lag_weeks: int = 1,
    station_counts: bool = False,
) -> DataFrame:
    """Rolling rain features at the close of each week, then moved ``lag_weeks`` later.

    With the default lag a week only sees what was known before it began. The
    seasonal columns describe the week itself and are never moved. Each row of
    ``daily`` may be a reading; several per day are added up.
    """
    keys = list(keys)
    at_end = _window_at_week_end(week_slots(daily, keys, day, value, station_counts), keys)
    enough = lambda minimum, c: F.when(F.col("_age") >= minimum, c)
    closing = at_end.select(
        *keys,
        "week_start",
        "fecha_fin_semana",
        *[enough(least, _total(_last_days(n))).alias(f) for f, (n, least) in ROLLING_SUMS.items()],
        enough(WET_MINIMUM, F.greatest(*_last_days(WET_WINDOW))).alias("precip_max_diario_14d"),
        enough(
            WET_MINIMUM,
            _total([(x > 0).cast("int") for x in _last_days(WET_WINDOW)]).cast("double"),
        ).alias("precip_dias_lluvia_14d"),
        *(
            [
                (
                    F.col("readings")
                    / (
                        F.datediff(
                            F.col("fecha_fin_semana"), F.greatest("week_start", "first_day")
                        )
                        + 1
                    )
                ).alias("n_estaciones")
            ]
            if station_counts
            else []
        ),
    )
    ordered = _by_series(keys).orderBy("week_start")
    moved = (lambda c: F.lag(c, lag_weeks).over(ordered)) if lag_weeks else F.col
    return closing.select(
        *keys,
        "week_start",
        *[moved(f).alias(f) for f in RAIN_FEATURES],
        *(["n_estaciones"] if station_counts else []),
        "fecha_fin_semana",
        F.month("fecha_fin_semana").alias("mes"),
        *seasonality(F.col("fecha_fin_semana"), F.col("fecha_fin_semana")),
    )


def interpolate_daily(
    daily: DataFrame, keys: Sequence[str] = (), day: str = "fecha", value: str = "value"
) -> DataFrame:
    """Complete daily series: linear inside gaps, carried forward at the end, null at the start.

    Every known point generates the days up to the next one, so the line through
    the gap is evaluated where its two ends are at hand. One row per (series, day)
    is expected. The series are dealt to a fixed number of tasks: their points are few bytes,
    and adaptive coalescing would otherwise leave the days of a great many series to one task.
    """
    keys = list(keys)
    if keys:
        daily = daily.repartition(max(SERIES_TASKS, shuffle_partitions(daily)), *keys)
    series = _by_series(keys)
    ordered = series.orderBy(day)
    spans = daily.where(F.col(day).isNotNull()).select(
        *keys,
        day,
        F.col(value).cast("double").alias("_v"),
        F.min(day).over(series).alias("_first"),
        F.max(day).over(series).alias("_last"),
        F.count(value).over(series).alias("_known"),
        F.row_number().over(ordered).alias("_at"),
    )
    points = spans.where(
        F.col("_v").isNotNull() | ((F.col("_known") == 0) & (F.col("_at") == 1))
    ).select(
        "*",
        F.lead(day).over(ordered).alias("_next_day"),
        F.lead("_v").over(ordered).alias("_next_v"),
        F.row_number().over(ordered).alias("_nth"),
    )
    begin = F.when(F.col("_nth") == 1, F.col("_first")).otherwise(F.col(day))
    until = F.coalesce(F.date_sub("_next_day", 1), F.col("_last"))
    steps = F.datediff("_day", day)
    line = F.col("_v") + (F.col("_next_v") - F.col("_v")) * steps / F.datediff("_next_day", day)
    return points.withColumn("_day", F.explode(F.sequence(begin, until))).select(
        *keys,
        F.col("_day").alias(day),
        F.when(steps < 0, None)
        .when(F.col("_next_day").isNull(), F.col("_v"))
        .otherwise(line)
        .alias(value),
    )


def weekly_soil_features(
    daily: DataFrame,
    keys: Sequence[str] = (),
    day: str = "fecha",
    value: str = "soil_moisture_m3m3",
    days: int = 14,
) -> DataFrame:
    """Rolling mean (at least half the days known) at the close of each week, one week later."""
    keys = list(keys)
    filled = interpolate_daily(daily, keys, day, value)
    frame = _by_series(keys).orderBy(day).rowsBetween(-(days - 1), Window.currentRow)
    rolling = filled.select(
        *keys,
        day,
        F.when(F.count(value).over(frame) >= days // 2, F.avg(value).over(frame)).alias("_r"),
    )
    weekly = rolling.groupBy(*keys, week_start(F.col(day)).alias("week_start")).agg(
        F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col(day))).alias("_close"),
        F.max(day).alias("fecha_fin_semana"),
    )
    ordered = _by_series(keys).orderBy("week_start")
    return weekly.select(
        *keys,
        "week_start",
        F.lag("_close").over(ordered).alias(SOIL_FEATURE),
        "fecha_fin_semana",
    )


def monthly_features(
    monthly: DataFrame, keys: Sequence[str], month: str = "mes_inicio", value: str = "precip_suma"
) -> DataFrame:
    """Previous month, 3- and 6-month sums and 3-month maximum of each series of months."""
    ordered = _by_series(keys).orderBy(month)
    back = lambda n: ordered.rowsBetween(-(n - 1), Window.currentRow)
    return monthly.select(
        "*",
        F.lag(value).over(ordered).alias("precip_lag1"),
        F.sum(value).over(back(3)).alias("precip_acum3m"),
        F.sum(value).over(back(6)).alias("precip_acum6m"),
        F.max(value).over(back(3)).alias("precip_max3m"),
    )


def weekly_coverage(daily: DataFrame, day: str = "fecha", value: str = "precip_mm") -> DataFrame:
    """Days with data, mean, maximum and coverage in percent of each week."""
    weekly = daily.groupBy(week_start(F.col(day)).alias("week_start")).agg(
        F.count(value).alias("n_dias"),
        F.avg(value).alias("precip_media"),
        F.max(value).alias("precip_max"),
    )
    share = F.col("n_dias") / 7.0 * 100
    return weekly.withColumn("cobertura_pct", F.greatest(F.lit(0.0), F.least(F.lit(100.0), share)))


def daily_coverage(readings: DataFrame, day: str = "fecha") -> DataFrame:
    """Days spanned (last minus first), days with data, and their ratio, in one row."""
    days = F.to_date(F.col(day))
    spanned = F.datediff(F.max(days), F.min(days))
    present = F.count_distinct(days)
    return readings.agg(
        spanned.cast("bigint").alias("dias_totales"),
        present.alias("dias_con_datos"),
        F.try_divide(present.cast("double"), spanned.cast("double")).alias("pct_cobertura"),
    )


def window_audit(
    daily: DataFrame, keys: Sequence[str] = (), day: str = "fecha", days: int = 14
) -> DataFrame:
    """How many days of a week, and of the week before, its closing window covers.

    This is the leakage check behind the one-week lag: unlagged, the window of a week
    contains the week itself. A week carries at most seven distinct days, so the
    collected sets are bounded.
    """
    weekly = daily.groupBy(*keys, week_start(F.col(day)).alias("week_start")).agg(
        F.collect_set(day).alias("_days"), F.max(day).alias("_end")
    )
    ordered = _by_series(keys).orderBy("week_start")
    adjacent = F.lag("week_start").over(ordered) == F.date_sub("week_start", 7)
    before = F.when(adjacent, F.lag("_days").over(ordered))
    weekly = weekly.withColumn("_before", F.coalesce(before, F.slice("_days", 1, 0)))
    begin = F.date_sub("_end", days - 1)
    covered = lambda c: F.size(F.filter(c, lambda d: d >= begin)).cast("bigint")
    return weekly.select(
        *keys,
        "week_start",
        covered("_days").alias("dias_semana"),
        covered("_before").alias("dias_semana_previa"),
    )
