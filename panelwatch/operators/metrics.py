"""Classification metrics over scored rows: columns ``y`` (0/1) and ``p``.

Everything ordered works on distinct scores with running counts, see ``ordering``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.functions.columns import safe_ratio
from panelwatch.functions.distributions import correlation_p, normal_two_sided
from panelwatch.operators.ordering import cumulative_by_value, exact_quantiles

HISTOGRAM_EDGES = (0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0)


def _labelled(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    # An explosion of one: a score is computed once for each row, not again for the filter.
    once = scored.select(*keys, "y", F.explode(F.array("p")).alias("p"))
    return once.where(F.col("y").isNotNull() & F.col("p").isNotNull()).select(
        *keys,
        F.col("p").cast("double").alias("p"),
        F.col("y").cast("bigint").alias("pos"),
        (1 - F.col("y")).cast("bigint").alias("neg"),
    )


def roc_auc(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve; a tied pair counts one half."""
    runs = cumulative_by_value(_labelled(scored, keys), "p", ["pos", "neg"], keys)
    beaten = F.col("neg_cum") - F.col("neg") / 2.0
    rows = runs.groupBy(*keys).agg(
        F.sum(F.col("pos") * beaten).alias("_u"),
        F.max("pos_total").alias("n_pos"),
        F.max("neg_total").alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return rows.select(
        *keys,
        F.try_divide(F.col("_u"), pairs).alias("auc_roc"),
        F.col("n_pos").cast("bigint").alias("n_pos"),
        F.col("n_neg").cast("bigint").alias("n_neg"),
    )


def pr_curve(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision and recall when everything at or above each distinct score is alerted."""
    runs = cumulative_by_value(_labelled(scored, keys), "p", ["pos", "neg"], keys)
    tp = F.col("pos_total") - F.col("pos_cum") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_cum") + F.col("neg")
    return runs.select(
        *keys,
        F.col("p").alias("threshold"),
        tp.cast("bigint").alias("tp"),
        fp.cast("bigint").alias("fp"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, F.col("pos_total")).alias("recall"),
        (tp - F.col("pos")).cast("bigint").alias("_tp_above"),
        (fp - F.col("neg")).cast("bigint").alias("_fp_above"),
        F.col("pos_total").cast("bigint").alias("_pos"),
    )


def pr_auc(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under the precision-recall curve, which starts at (0, 1).

    The point above a score follows from the same running counts, so no ``lag`` across
    buckets is needed.
    """
    curve = pr_curve(scored, keys)
    seen = F.col("_tp_above") + F.col("_fp_above")
    above = F.when(seen == 0, 1.0).otherwise(F.col("_tp_above") / seen)
    step = F.col("recall") - safe_ratio(F.col("_tp_above"), F.col("_pos"))
    area = F.sum(step * (F.col("precision") + above) / 2)
    return curve.groupBy(*keys).agg(area.alias("pr_auc"), F.count(F.lit(1)).alias("n_thresholds"))


def confusion_columns(threshold: float = 0.5) -> list:
    hit, real = F.col("p") >= threshold, F.col("y") == 1
    return [
        F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"),
        F.count_if(~hit & ~real).alias("tn"),
    ]


def with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_ratio(fp, fp + tn).alias("fpr"),
    )


def binary_metrics(scored: DataFrame, keys: Sequence[str] = (), threshold: float = 0.5):
    """Counts and rates at one threshold; every empty denominator gives 0."""
    return with_rates(scored.groupBy(*keys).agg(*confusion_columns(threshold)))


def confusion_by_fold(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Each fold, and all of them pooled as fold 0: both from one set of partial sums."""
    folds = scored.groupBy("fold").agg(*confusion_columns(threshold))
    sums = [F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]
    both = folds.rollup("fold").agg(*sums)
    return with_rates(both.withColumn("fold", F.coalesce("fold", F.lit(0))))


def full_metrics(scored: DataFrame, keys: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """AUC, recall, precision, F1 and class counts, as published for the unfiltered grid.

    The running counts serve both the area and the confusion counts: one pass.
    """
    runs = cumulative_by_value(_labelled(scored, keys), "p", ["pos", "neg"], keys)
    hit = F.col("p") >= threshold
    rows = runs.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") / 2.0)).alias("_u"),
        F.max("pos_total").cast("bigint").alias("n_pos"),
        F.max("neg_total").cast("bigint").alias("n_neg"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("_fp"),
    )
    tp, fp, pos, neg = (F.col(c) for c in ("_tp", "_fp", "n_pos", "n_neg"))
    return rows.select(
        *keys,
        F.try_divide(F.col("_u"), pos.cast("double") * neg).alias("auc_roc_full"),
        safe_ratio(tp, pos).alias("recall_full"),
        safe_ratio(tp, tp + fp).alias("precision_full"),
        safe_ratio(2 * tp, tp + fp + pos).alias("f1_full"),
        (pos + neg).alias("n_total_full"),
        pos.alias("n_positivos_full"),
        neg.alias("n_negativos_full"),
    )


def fold_summary(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each metric over the folds; 0 if there are none."""
    return per_fold.agg(
        *[F.coalesce(F.avg(m), F.lit(0.0)).alias(f"{m}_mean") for m in metrics],
        *[F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias(f"{m}_std") for m in metrics],
    )


def score_histogram(scored: DataFrame, edges: Sequence[float] = HISTOGRAM_EDGES) -> DataFrame:
    """Positives and negatives per score band; bands are closed left, open right, the last closed."""
    band = F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        below = F.col("p") <= high if high == edges[-1] else F.col("p") < high
        band = F.when((F.col("p") >= low) & below, i).otherwise(band)
    counted = (
        scored.withColumn("banda", band)
        .where(F.col("banda").isNotNull())
        .groupBy("banda")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("n_pos"))
    )
    lows = F.array(*[F.lit(float(e)) for e in edges])
    return counted.select(
        F.get(lows, F.col("banda")).alias("desde"),
        F.get(lows, F.col("banda") + 1).alias("hasta"),
        "n",
        "n_pos",
        (F.col("n") - F.col("n_pos")).alias("n_neg"),
    )


def separability(cells: DataFrame, value: str, label: str = "y") -> DataFrame:
    """Per class: count, quartiles, extremes; and whether the classes overlap at all."""
    valid = cells.where(F.col(value).isNotNull()).select(F.col(label).alias("clase"), value)
    stats = valid.groupBy("clase").agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("minimo"), F.max(value).alias("maximo")
    )
    quartiles = exact_quantiles(valid, value, {"p25": 0.25, "mediana": 0.5, "p75": 0.75}, ["clase"])
    both = Window.partitionBy()  # two rows
    top_negative = F.max(F.when(F.col("clase") == 0, F.col("maximo"))).over(both)
    low_positive = F.min(F.when(F.col("clase") == 1, F.col("minimo"))).over(both)
    return stats.join(quartiles, "clase").withColumn("solapan", low_positive <= top_negative)


def _correlation(a: str, b: str) -> Column:
    """Pearson's r over the rows that have both; null where a side is constant (``corr`` divides by zero there)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs as (a, b, r), rows with a null in the pair left out, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[_correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return long.select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"),
        "r",
    )


def significant(tested: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``tested`` with the flag of its p-value and its place by p-value (nulls last), then name."""
    order = Window.orderBy(F.asc_nulls_last("p_value"), "feature")  # one row for each feature
    flag = (F.col("p_value") < alpha).alias("significativa")
    return tested.select("*", flag, F.row_number().over(order).cast("bigint").alias("orden"))


def point_biserial(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """r between each feature and a 0/1 label, with its p-value (Student's t)."""
    row = df.agg(
        *[_correlation(f, label).alias(f"{f}|r") for f in features],
        *[
            F.count(F.when(F.col(label).isNotNull(), F.col(f))).cast("double").alias(f"{f}|n")
            for f in features
        ],
    )
    fields = ", ".join(f"'{f}', `{f}|r`, `{f}|n`" for f in features)
    long = row.selectExpr(f"stack({len(features)}, {fields}) as (feature, r, n)")
    p = correlation_p(F.col("r"), F.col("n"))
    return long.select("feature", F.col("n").cast("bigint").alias("n"), "r", p.alias("p_value"))


def spearman(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rank correlation of each feature with a label, and its p-value (Student's t).

    Pearson over average ranks, on distinct pairs with their counts; all features in one pass.
    """
    named = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("_a")) for f in features]
    )
    pairs = (
        df.select(F.explode(named).alias("_x"), F.col(label).cast("double").alias("_b"))
        .select("_x.*", "_b")
        .where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
        .groupBy("feature", "_a", "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def ranks(c):
        runs = cumulative_by_value(pairs.select("feature", c, "_n"), c, ["_n"], ["feature"])
        rank = F.col("_n_cum") - (F.col("_n") - 1) / 2.0
        return runs.select("feature", c, rank.alias(f"{c}_rank"))

    ranked = pairs.join(ranks("_a"), ["feature", "_a"]).join(ranks("_b"), ["feature", "_b"])
    x, y, w = F.col("_a_rank"), F.col("_b_rank"), F.col("_n")
    sums = ranked.groupBy("feature").agg(
        F.sum(w).alias("n"),
        F.sum(w * x).alias("x"),
        F.sum(w * y).alias("y"),
        F.sum(w * x * y).alias("xy"),
        F.sum(w * x * x).alias("xx"),
        F.sum(w * y * y).alias("yy"),
    )
    n = F.col("n")
    cov = F.col("xy") / n - F.col("x") / n * (F.col("y") / n)
    var_x = F.col("xx") / n - F.pow(F.col("x") / n, F.lit(2))
    var_y = F.col("yy") / n - F.pow(F.col("y") / n, F.lit(2))
    rho = F.try_divide(cov, F.sqrt(var_x * var_y))
    return sums.select(
        "feature", n.cast("bigint").alias("n"), rho.alias("rho"), correlation_p(rho, n).alias("p_value")
    )


def roc_curve(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """True and false positive rates when everything at or above each distinct score is alerted."""
    runs = cumulative_by_value(_labelled(scored, keys), "p", ["pos", "neg"], keys)
    tp = F.col("pos_total") - F.col("pos_cum") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_cum") + F.col("neg")
    return runs.select(
        *keys,
        F.col("p").alias("threshold"),
        safe_ratio(tp, F.col("pos_total")).alias("tpr"),
        safe_ratio(fp, F.col("neg_total")).alias("fpr"),
    )


def mann_whitney(df: DataFrame, value: str, label: str) -> DataFrame:
    """U of the rows labelled 0 against those labelled 1, two-sided normal p with tie correction."""
    groups = df.where(F.col(value).isNotNull() & F.col(label).isNotNull()).select(
        F.col(value).cast("double").alias("_v"),
        (1 - F.col(label)).cast("bigint").alias("g0"),
        F.col(label).cast("bigint").alias("g1"),
    )
    runs = cumulative_by_value(groups, "_v", ["g0", "g1"])
    tied = (F.col("g0") + F.col("g1")).cast("double")
    row = runs.agg(
        F.sum(F.col("g0") * (F.col("g1_cum") - F.col("g1") / 2.0)).alias("u"),
        F.max("g0_total").cast("double").alias("n0"),
        F.max("g1_total").cast("double").alias("n1"),
        F.sum(tied * tied * tied - tied).alias("_ties"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    n = n0 + n1
    sigma = F.sqrt(n0 * n1 / 12 * ((n + 1) - F.col("_ties") / (n * (n - 1))))
    # Continuity correction of one half, as the usual two-sided asymptotic test.
    z = (F.abs(F.col("u") - n0 * n1 / 2) - 0.5) / sigma
    return row.select(
        n0.cast("bigint").alias("n0"),
        n1.cast("bigint").alias("n1"),
        "u",
        normal_two_sided(F.greatest(z, F.lit(0.0))).alias("p_value"),
    )


def promotion(candidates: DataFrame, settings) -> DataFrame:
    """Flag and reasons for each candidate's metrics on the unfiltered grid."""
    auc, precision = F.col("auc_roc_full"), F.col("precision_full")
    low_auc, low_precision = auc < settings.promote_auc, precision < settings.promote_precision
    reasons = F.concat_ws(
        " | ",
        F.when(low_auc, F.format_string(f"AUC %.4f < {settings.promote_auc}", auc)),
        F.when(
            low_precision,
            F.format_string(f"Precision %.4f < {settings.promote_precision}", precision),
        ),
    )
    return candidates.withColumn("promovido", ~(low_auc | low_precision)).withColumn(
        "razon", reasons
    )


def best_candidate(candidates: DataFrame, metric: str, exclude: Sequence[str]) -> DataFrame:
    """The candidate with the largest metric, baselines left out; ties go to the first name."""
    return (
        candidates.where(~F.col("modelo").isin(*exclude))
        .orderBy(F.desc(metric), "modelo")
        .limit(1)
    )
