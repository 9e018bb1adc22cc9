"""Feature drift: stored reference statistics and the two-sample Kolmogorov-Smirnov test."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.operators.ordering import cumulative_by_value, exact_quantiles
from panelwatch.operators.panel import unpivot_features
from panelwatch.settings import Settings

SERIES_TERMS = 20


def reference_statistics(cells: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, population deviation and exact quartiles of each feature."""
    long = unpivot_features(cells, features)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
    )
    quartiles = exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["feature"])
    return moments.join(quartiles, "feature")


def kolmogorov_tail(x: Column, terms: int = SERIES_TERMS) -> Column:
    """2 sum (-1)^(k-1) exp(-2 k^2 x^2), the limit law of the scaled statistic."""
    total = sum(
        (1 if k % 2 else -1) * F.exp(F.lit(-2.0 * k * k) * x * x) for k in range(1, terms + 1)
    )
    # The series does not converge near 0, where the probability is 1.
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


def ks_test(
    reference: DataFrame, recent: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """KS statistic, p-value and drift flag of each feature; inputs are (feature, value).

    Features with fewer than ten recent values are left out. Both samples are
    merged by value before anything is ordered.
    """
    one = F.lit(1).alias("n")
    return ks_of_states(reference.select("feature", "value", one), recent.select("feature", "value", one), settings)


def ks_of_states(reference: DataFrame, recent: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The same of counted samples (feature, value, n), e.g. of merged states."""
    none = F.lit(0).cast("bigint")
    both = reference.select("feature", "value", F.col("n").cast("bigint").alias("a"), none.alias("b")).union(
        recent.select("feature", "value", none.alias("a"), F.col("n").cast("bigint").alias("b"))
    )
    runs = cumulative_by_value(both, "value", ["a", "b"], ["feature"])
    gap = F.abs(F.col("a_cum") / F.col("a_total") - F.col("b_cum") / F.col("b_total"))
    rows = (
        runs.where((F.col("b_total") >= settings.drift_min_rows) & (F.col("a_total") > 0))
        .groupBy("feature")
        .agg(
            F.max(gap).alias("estadistico_ks"),
            F.max("a_total").cast("bigint").alias("n_referencia"),
            F.max("b_total").cast("bigint").alias("n_produccion"),
        )
    )
    n, m = F.col("n_referencia"), F.col("n_produccion")
    p = kolmogorov_tail(F.sqrt(n.cast("double") * m / (n + m)) * F.col("estadistico_ks"))
    return rows.withColumn("p_value", p).withColumn("drift", F.col("p_value") < settings.drift_alpha)


def week_states(cells: DataFrame, features: Sequence[str], week: str = "week_start") -> DataFrame:
    """State of each week: (week, feature, value, n), one row for each distinct value."""
    named = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = cells.select(week, F.inline(F.array(*named))).where(F.col("value").isNotNull())
    return long.groupBy(week, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """States joined by addition: (feature, value, n)."""
    whole = reduce(DataFrame.unionByName, [s.select("feature", "value", "n") for s in states])
    return whole.groupBy("feature", "value").agg(F.sum("n").alias("n"))


def append_state(cells: DataFrame, features: Sequence[str], path: str, week: str = "week_start") -> None:
    """Writes the states of the weeks in ``cells``, one folder a week; other weeks stay as they are.

    A week that is there already is replaced, so that a job can be repeated after a failure.
    """
    states = week_states(cells, features, week).repartition(week)
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(week).parquet(path)


def read_state(spark: SparkSession, path: str, week: str = "week_start") -> DataFrame:
    schema = f"feature string, value double, n bigint, {week} date"
    return spark.read.schema(schema).parquet(path)


def drift_summary(tested: DataFrame) -> DataFrame:
    """One row: any drift, and the drifted features (as many as are monitored) by name."""
    return tested.agg(
        F.coalesce(F.bool_or("drift"), F.lit(False)).alias("drift_detectado"),
        F.concat_ws(
            ",", F.array_sort(F.collect_list(F.when(F.col("drift"), F.col("feature"))))
        ).alias("features_con_drift"),
    )
