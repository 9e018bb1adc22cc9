"""Consequences, their cost, risk index, and the economics of alerting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.columns import number_or_zero, pick_column, safe_ratio
from panelwatch.functions.risk import LEVELS, index_band
from panelwatch.functions.rounding import exact_round, to_fixed
from panelwatch.operators.ordering import top_k_per_group, with_global_rank
from panelwatch.settings import (
    CONSEQUENCE_SYNONYMS,
    CONSEQUENCES,
    COP_PER_USD,
    UNIT_PRICE_COP,
    Economics,
)


def standard_consequences(events: DataFrame) -> DataFrame:
    """Adds the seven consequence columns, found by synonym, numeric, 0 where unreadable."""
    for name, words in CONSEQUENCE_SYNONYMS.items():
        source = name if name in events.columns else pick_column(events, *words, required=False)
        value = number_or_zero(F.col(source)) if source else F.lit(0.0)
        events = events.withColumn(name, value)
    return events


def cost(columns: Sequence[str] = CONSEQUENCES) -> Column:
    """Weighted sum of the consequence columns by their unit prices, in COP."""
    return reduce(add, [F.col(c) * float(UNIT_PRICE_COP[c]) for c in columns])


def impact_totals(events: DataFrame) -> DataFrame:
    """One row: every consequence, events, total cost, cost per event and in USD."""
    row = events.agg(
        F.count(F.lit(1)).alias("n_eventos"), *[F.sum(c).alias(c) for c in CONSEQUENCES]
    )
    return (
        row.withColumn("costo_cop", cost())
        .withColumn("costo_por_evento", F.try_divide("costo_cop", F.col("n_eventos").cast("double")))
        .withColumn("costo_usd", F.col("costo_cop") / COP_PER_USD)
    )


def impact_by_year(events: DataFrame) -> DataFrame:
    return events.groupBy(F.year("fecha").alias("anio")).agg(
        F.count(F.lit(1)).alias("n_eventos"),
        F.sum("fallecidos").alias("fallecidos"),
        F.sum("personas").alias("personas"),
        F.sum("viviendas_destruidas").alias("viviendas_destruidas"),
    )


def year_mix(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each consequence within its year, in percent."""
    yearly = events.groupBy(F.year("fecha").alias("anio")).agg(*[F.sum(c).alias(c) for c in columns])
    total = reduce(add, [F.col(c) for c in columns])
    return yearly.select("anio", *[F.try_divide(F.col(c) * 100.0, total).alias(c) for c in columns])


def impact_by_unit(events: DataFrame, units: DataFrame) -> DataFrame:
    """Sums and events of every unit, 0 where there were none, with cost in millions."""
    sums = events.groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("n_eventos"), *[F.sum(c).alias(c) for c in CONSEQUENCES]
    )
    filled = units.join(sums, "unit_id", "left").fillna(0, ["n_eventos", *CONSEQUENCES])
    return filled.withColumn("costo_cop", cost()).withColumn(
        "costo_m_cop", F.col("costo_cop") / 1e6
    )


def risk_index(impact: DataFrame) -> DataFrame:
    """Events times people over area: needs n_eventos, poblacion_estimada, sub_area."""
    value = F.col("n_eventos") * F.col("poblacion_estimada") / (F.col("sub_area") + 1)
    return impact.withColumn("indice_riesgo", value)


def top_by(df: DataFrame, metric: str, k: int, tie: str = "unit_id") -> DataFrame:
    """Rows with the k largest positive values."""
    return df.where(F.col(metric) > 0).orderBy(F.desc(metric), tie).limit(k)


def top_places(events: DataFrame, place: str, k: int = 10) -> DataFrame:
    summed = events.groupBy(place).agg(
        *[F.sum(c).alias(c) for c in CONSEQUENCES], F.count(F.lit(1)).alias("n_eventos")
    )
    return summed.orderBy(F.desc("fallecidos"), place).limit(k)


def priority(
    predictions: DataFrame,
    impact: DataFrame,
    levels: Sequence[str] = ("Alto", "Medio", "Bajo"),
    only_with_events: bool = False,
) -> DataFrame:
    """score = p (1 + index / max(index, 1)); filtered by level, unranked."""
    top = F.greatest(F.lit(1.0), impact.agg(F.max("indice_riesgo")).scalar())
    kept = ["n_eventos", "fallecidos", "costo_m_cop", "poblacion_estimada", "indice_riesgo"]
    rows = predictions.join(impact.select("unit_id", *kept), "unit_id", "left").fillna(0, kept)
    share = F.col("indice_riesgo") / top
    scored = rows.withColumn("score", F.col("p") * (1 + share)).where(
        F.col("nivel_riesgo").isin(*levels)
    )
    return scored.where(F.col("n_eventos") > 0) if only_with_events else scored


def priority_top(scored: DataFrame, k: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("score"), "unit_id").limit(k)


def historic_top(impact: DataFrame, k: int = 10, only_with_events: bool = False) -> DataFrame:
    """What the map lists before a week is scored: the highest historic indices above 1000."""
    rows = impact.where(F.col("indice_riesgo") > 1000)
    if only_with_events:
        rows = rows.where(F.col("n_eventos") > 0)
    score = F.col("indice_riesgo") / 5000
    return (
        rows.orderBy(F.desc("indice_riesgo"), "unit_id")
        .limit(k)
        .select(
            "unit_id",
            F.least(score, F.lit(0.99)).alias("p"),
            F.lit("Alto").alias("nivel_riesgo"),
            "n_eventos",
            "costo_m_cop",
            score.alias("score"),
        )
    )


def historic_band_counts(impact: DataFrame) -> DataFrame:
    """Units per band of the historic index, in one row."""
    level = index_band(F.col("indice_riesgo"))
    return impact.agg(*[F.count_if(level == b).alias(b.lower()) for b in reversed(LEVELS)])


def priority_export(scored: DataFrame) -> DataFrame:
    """Every row with its rank and the columns formatted as in the exported file."""
    ranked = with_global_rank(scored, "score", "unit_id")
    return ranked.select(
        "rank",
        "unit_id",
        to_fixed(F.col("p") * 100, 1).alias("prob_pct"),
        F.col("nivel_riesgo").alias("nivel"),
        F.col("n_eventos").cast("bigint").alias("eventos_hist"),
        F.col("fallecidos").cast("bigint").alias("fallecidos"),
        to_fixed(F.col("costo_m_cop"), 0).alias("costo_m_cop"),
        F.col("poblacion_estimada").cast("bigint").alias("poblacion"),
        to_fixed(F.col("score"), 3).alias("score"),
    )


def projected_counts(recall: Column, precision: Column, n_events: Column) -> tuple[Column, ...]:
    """True and false positives and misses when the rates meet the historic events."""
    tp = exact_round(recall * n_events, 0)
    fp = F.when(precision > 0, exact_round(tp * (1 - precision) / precision, 0)).otherwise(0.0)
    return tp, fp, n_events - tp


def benefit_ratio(
    tp: Column, fp: Column, fn: Column, base: Column, unit: Column, reduction, money: Economics
) -> tuple[Column, Column]:
    """(benefit, ratio) of alerting: what is saved over operation plus false alarms."""
    alarms = fp * money.false_alarm_cost
    with_system = tp * unit * (1 - reduction) + fn * unit + alarms + money.system_cost
    benefit = base - with_system
    return benefit, F.try_divide(benefit, alarms + money.system_cost)


def _historic(totals: DataFrame) -> dict[str, Column]:
    """The one-row totals as scalar subqueries."""
    return {
        c: totals.select(F.col(c).cast("double")).scalar()
        for c in ("n_eventos", "costo_cop", "costo_por_evento")
    }


def bcr_scenarios(rates: DataFrame, totals: DataFrame, money: Economics = Economics()) -> DataFrame:
    """Benefit-cost for each damage reduction, from one row of recall and precision."""
    past = _historic(totals)
    row = rates.select(
        "recall",
        "precision",
        past["n_eventos"].alias("_n"),
        past["costo_cop"].alias("_base"),
        past["costo_por_evento"].alias("_unit"),
        F.explode(F.array(*[F.lit(f) for f in money.reductions])).alias("factor_reduccion"),
    )
    tp, fp, fn = projected_counts(F.col("recall"), F.col("precision"), F.col("_n"))
    row = row.select("*", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    benefit, ratio = benefit_ratio(
        F.col("tp"), F.col("fp"), F.col("fn"), F.col("_base"), F.col("_unit"),
        F.col("factor_reduccion"), money,
    )
    return row.select(
        "factor_reduccion",
        "tp",
        "fp",
        "fn",
        (benefit / 1e6).alias("beneficio_m_cop"),
        F.round(ratio, 3).alias("bcr"),
        (ratio >= 1).alias("rentable"),
    )


def threshold_sweep(
    scored: DataFrame, totals: DataFrame, money: Economics = Economics(), steps: int = 19
) -> DataFrame:
    """Rates, projected counts and ratio for thresholds 0.05, 0.10, ... 0.95.

    A row counts for every threshold up to its score, so it is enough to find the
    highest one, count rows per such step, and add the few steps up from the top.
    """
    thresholds = [F.lit(i / (steps + 1)) for i in range(1, steps + 1)]
    reached = reduce(add, [(F.col("p") >= t).cast("int") for t in thresholds])
    per_step = scored.groupBy(reached.alias("_step")).agg(
        F.count_if(F.col("y") == 1).alias("_pos"), F.count_if(F.col("y") == 0).alias("_neg")
    )
    steps_up = per_step.withColumn(
        "paso", F.explode(F.sequence(F.lit(1), F.lit(steps)))
    )  # at most (steps + 1) * steps rows
    above = F.col("_step") >= F.col("paso")
    counts = steps_up.groupBy("paso").agg(
        F.sum(F.when(above, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(above, 0).otherwise(F.col("_pos"))).alias("fn"),
    )
    past = _historic(totals)
    rates = counts.select(
        (F.col("paso") / (steps + 1)).alias("umbral"),
        "tp",
        "fp",
        "fn",
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        past["n_eventos"].alias("_n"),
        past["costo_cop"].alias("_base"),
        past["costo_por_evento"].alias("_unit"),
    ).where(F.col("tp") + F.col("fn") > 0)
    tp, fp, fn = projected_counts(F.col("recall"), F.col("precision"), F.col("_n"))
    rates = rates.select("*", tp.alias("tp_real"), fp.alias("fp_real"), fn.alias("_fn_real"))
    _, ratio = benefit_ratio(
        F.col("tp_real"), F.col("fp_real"), F.col("_fn_real"), F.col("_base"), F.col("_unit"),
        money.reductions[0], money,
    )
    return rates.select(
        "umbral", "tp", "fp", "fn", "recall", "precision", "tp_real", "fp_real",
        F.round(ratio, 3).alias("bcr"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold with the largest ratio."""
    return sweep.orderBy(F.desc("bcr"), "umbral").limit(1)


def top_n_alerts(
    scored: DataFrame, totals: DataFrame, money: Economics = Economics()
) -> DataFrame:
    """Only the N most probable units of each week are alerted, for several N.

    Rows are first cut to the largest N per week (salted, so no week is one task),
    then counted by rank; the few counts are added up per N.
    """
    sizes = money.alert_sizes
    ranked = top_k_per_group(
        scored, ["week_start"], [F.desc("p"), F.asc("unit_id")], max(sizes), ["unit_id"]
    )
    by_rank = ranked.groupBy("rank").agg(
        F.count_if(F.col("y") == 1).alias("_hits"), F.count_if(F.col("y") == 0).alias("_false")
    )
    counts = (
        by_rank.withColumn("n_alertas", F.explode(F.array(*[F.lit(n) for n in sizes])))
        .where(F.col("rank") <= F.col("n_alertas"))
        .groupBy("n_alertas")
        .agg(F.sum("_hits").alias("aciertos"), F.sum("_false").alias("falsas_alarmas"))
    )
    past = _historic(totals)
    positives = scored.agg(F.sum("y").cast("double")).scalar()
    row = counts.select(
        "n_alertas",
        "aciertos",
        "falsas_alarmas",
        safe_ratio(F.col("aciertos"), positives).alias("recall"),
        safe_ratio(F.col("aciertos"), F.col("aciertos") + F.col("falsas_alarmas")).alias(
            "precision"
        ),
        past["n_eventos"].alias("_n"),
        past["costo_cop"].alias("_base"),
        past["costo_por_evento"].alias("_unit"),
    )
    tp = exact_round(F.col("recall") * F.col("_n"), 0)
    row = row.select("*", tp.alias("_tp"))
    _, ratio = benefit_ratio(
        F.col("_tp"), F.col("falsas_alarmas"), F.col("_n") - F.col("_tp"), F.col("_base"),
        F.col("_unit"), money.reductions[0], money,
    )
    return row.select(
        "n_alertas", "aciertos", "falsas_alarmas", "recall", "precision",
        F.round(ratio, 3).alias("bcr"),
    )
