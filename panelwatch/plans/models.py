"""Classifiers on Spark ML: preparation, bagging for unlabelled negatives, panel validation.

A model family is fitted on rows prepared once: imputed, assembled and scaled by
statistics of the training side alone. Loops here only submit jobs (folds, draws,
bags); every fit and every score is distributed.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.operators.folds import fold_sides, fold_table
from panelwatch.operators.metrics import fold_summary, full_metrics
from panelwatch.operators.ordering import cumulative_by_value, exact_quantiles
from panelwatch.operators.panel import unpivot_features, year_slice
from panelwatch.plans.linear import unpivoted
from panelwatch.settings import MODEL_FEATURES, TARGET, Settings

KEYS = ["week_start", "unit_id"]
SEED = 42
CV_METRICS = ("auc_roc", "f1", "precision", "recall")


def hash_code(columns: Sequence[str], seed: int) -> Column:
    """Whole number below 2**32 fixed by a row's key, whatever the partitioning or the engine."""
    digits = F.substring(F.md5(F.concat_ws(":", *columns, F.lit(seed))), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def hash_unit(columns: Sequence[str], seed: int) -> Column:
    """The same as a number in [0, 1)."""
    return hash_code(columns, seed).cast("double") / float(2**32)


def usable_features(cells: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> list[str]:
    """Features present and not wholly null (an imputer cannot fit those), in order."""
    present = [f for f in features if f in cells.columns]
    row = cells.agg(*[F.count(f).alias(f) for f in present]).first()
    return [f for f in present if row[f] > 0]


def model_rows(cells: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """Keys, double features and the label; columns derived from the label are refused."""
    if {"n_eventos", target} & set(features):
        raise ValueError("label-derived columns cannot be features")
    label = F.col(target) if target in cells.columns else F.lit(None)
    return cells.select(
        *KEYS,
        *[F.col(f).cast("double").alias(f) for f in features],
        label.cast("double").alias("label"),
    )


def medians(rows: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature; one row for each feature comes to the driver."""
    long = unpivot_features(rows, features)
    found = exact_quantiles(long, "value", {"median": 0.5}, ["feature"]).collect()
    return {r["feature"]: r["median"] for r in found}


def preparation(features: Sequence[str], fill: dict[str, float]) -> Pipeline:
    """Nulls filled (with the medians of the training side), then standardisation."""
    filled = ", ".join(f"coalesce(`{f}`, {fill[f]!r}D) AS `{f}__f`" for f in features)
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            VectorAssembler(inputCols=[f"{f}__f" for f in features], outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        ]
    )


@dataclass
class Prepared:
    """Training rows as vectors with balanced weights n / (2 n_class), kept for many fits."""

    rows: DataFrame
    transformer: PipelineModel
    features: list[str]
    n: int
    positives: int
    fill: dict[str, float]

    @staticmethod
    def of(cells: DataFrame, fill: dict[str, float] | None = None, per_task: int | None = None) -> Prepared:
        """``fill`` has the medians of the usable features, where they are known already.

        With ``per_task`` the rows lie in as few partitions as hold about so many rows each.
        """
        features = usable_features(cells) if fill is None else [f for f in MODEL_FEATURES if f in fill]
        rows = model_rows(cells, features).where(F.col("label").isNotNull())
        fill = fill or medians(rows, features)
        transformer = preparation(features, fill).fit(rows)
        counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
        n, pos = counts["n"], int(counts["pos"] or 0)
        if not 0 < pos < n:
            raise ValueError("training rows must hold both classes")
        weight = F.when(F.col("label") == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))
        vectors = transformer.transform(rows).select(
            *KEYS, "features", "label", weight.alias("weight")
        )
        # The layout follows the keys, so that draws by partition don't depend on stored files.
        wide = [math.ceil(n / per_task)] if per_task else []
        placed = vectors.repartition(*wide, *KEYS).sortWithinPartitions(*KEYS)
        return Prepared(placed.persist(), transformer, features, n, pos, fill)

    def release(self) -> None:
        self.rows.unpersist()


def logistic(data: Prepared, c: float = Settings.logistic_c) -> list:
    """L2 logistic regression; ``c`` is the inverse penalty of the summed loss."""
    model = LogisticRegression(
        weightCol="weight", maxIter=500, regParam=1.0 / (c * data.n), elasticNetParam=0.0,
        standardization=False, tol=1e-4,
    )
    return [model.fit(data.rows)]


#: (row, tree) pairs whose places in the trees are held between the levels of a fit (4 bytes each).
PLACES_HELD = 1 << 28


def holds_places(data: Prepared, trees: int) -> bool:
    """Whether a forest keeps the node of every row in every tree, instead of finding it again for each level."""
    return data.n * trees <= PLACES_HELD


def random_forest(
    data: Prepared,
    trees: int = Settings.forest_trees,
    depth: int = Settings.forest_depth,
    min_leaf: int = Settings.forest_min_leaf,
) -> list:
    model = RandomForestClassifier(
        weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=SEED,
        cacheNodeIds=holds_places(data, trees),
    )
    return [model.fit(data.rows)]


def gradient_boosting(data: Prepared, rounds: int = 100, depth: int = 3) -> list:
    return [GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=SEED).fit(data.rows)]


#: Cumulative probabilities of how often a bootstrap of n draws takes a row (Poisson, mean one).
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(10)]
#: Hashes of 32 bits are counted by so many leading bits first.
LEADING_BITS = 12
#: Weights are whole multiples of this, so that their sums are exact in any order.
GRAIN = 1024


def drawn(columns: Sequence[str], seed: int) -> Column:
    """How often a bootstrap takes a row: a quantile of its hash, whatever the layout of the rows."""
    u = hash_unit(columns, seed)
    return reduce(add, [(u >= c).cast("int") for c in POISSON])


def hashed_forest(
    data: Prepared,
    trees: int = Settings.forest_trees,
    depth: int = Settings.forest_depth,
    min_leaf: int = Settings.forest_min_leaf,
) -> list:
    """A random forest of single trees whose bootstraps are hashes of row key and tree.

    ``random_forest`` draws by partition, so its trees depend on how the rows are stored; here
    two layouts of the same rows give the same trees (up to 10,000 rows; beyond, Spark looks for
    cut points in a sample of that size, taken by partition). Each tree is a fit of its own, with only
    as many tasks as its rows need; other trees fill the cores.
    """
    tasks, at_once = fit_tasks(data.rows, data.n)
    near = data.rows.coalesce(tasks)

    def tree(i: int):
        rows = near.withColumn("boot", drawn(KEYS, SEED + i)).where("boot > 0")
        weight = F.round(F.col("weight") * GRAIN) / GRAIN * F.col("boot")
        one = RandomForestClassifier(
            weightCol="weight", numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=depth,
            minInstancesPerNode=min_leaf, seed=SEED + i,
        )
        # A fit reads its rows three times.
        kept = rows.withColumn("weight", weight).drop("boot").persist()
        try:
            return one.fit(kept)
        finally:
            kept.unpersist()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(tree, range(trees)))


def bag_masks(rows: DataFrame, positives: int, bags: int, seed: int = SEED) -> DataFrame:
    """``rows`` with ``mask``: bit i says whether the row is in bag i (63 bags at most).

    A bag has all positives and the ``positives`` unlabelled rows with the smallest hashes (ties
    by key). The hashes where the bags are full are found for all bags at once: hashes are counted by
    their leading bits, and running totals are needed only where a bag's count is reached. Only rows
    that have one of the very hashes found are ranked.
    """
    if bags > 63:
        raise ValueError("a mask has 63 bits")
    # Positives need no hash.
    coded = rows.withColumn("_codes", F.when(F.col("label") == 0, F.array(*[hash_code(KEYS, seed + i) for i in range(bags)])))
    unlabelled = coded.where(F.col("label") == 0)
    draws = unlabelled.select(*KEYS, F.posexplode("_codes").alias("_bag", "_code"))
    # At most 2**LEADING_BITS rows for each bag, one of which is kept.
    leading = F.col("_code").bitwiseAND(-1 << (32 - LEADING_BITS)).alias("_lead")
    counts = draws.groupBy("_bag", leading).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_bag").orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = counts.withColumn("_before", before).where(F.col("_before") < positives).groupBy("_bag").agg(
        F.max("_lead").alias("_lead"), F.max("_before").alias("_before")
    )
    near = draws.join(F.broadcast(reached), "_bag").where(leading == F.col("_lead"))
    runs = cumulative_by_value(near.select("_bag", "_before", "_code", F.lit(1).alias("_one")), "_code", ["_one"], ["_bag", "_before"])
    below = F.col("_before") + F.col("_one_cum") - F.col("_one")
    # One row for each bag.
    limits = runs.where(below < positives).groupBy("_bag").agg(
        F.max("_code").alias("_last"), (positives - F.max(below)).alias("_room")
    )
    ties = draws.join(F.broadcast(limits), "_bag").where(F.col("_code") == F.col("_last"))
    first = F.row_number().over(Window.partitionBy("_bag").orderBy(*KEYS)) <= F.col("_room")
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i)
    tied = ties.withColumn("_in", first).where("_in").groupBy(*KEYS).agg(F.sum(bit(F.col("_bag"))).alias("_tied"))
    last = limits.agg(F.map_from_entries(F.collect_list(F.struct("_bag", "_last")))).scalar()
    everywhere = sum(1 << i for i in range(bags))
    known = coded.withColumn("_limits", last).join(tied, KEYS, "left")
    drawn_bits = reduce(
        add,
        [F.when(F.get("_codes", F.lit(i)) < F.element_at("_limits", F.lit(i)), 1 << i).otherwise(0).cast("bigint") for i in range(bags)],
    )
    mask = F.when(F.col("label") == 1, F.lit(everywhere).cast("bigint")).otherwise(
        drawn_bits + F.coalesce("_tied", F.lit(0).cast("bigint"))
    )
    return known.withColumn("mask", mask).drop("_codes", "_limits", "_tied")


def in_bag(mask: Column, bag: int) -> Column:
    return mask.bitwiseAND(1 << bag) != 0


def out_of_bag_mean(mask: Column, scores: Sequence[Column]) -> Column:
    """Mean of the scores of the bags that a row isn't in; null if it is in all."""
    outside = [~in_bag(mask, i) for i in range(len(scores))]
    total = reduce(add, [F.when(o, s).otherwise(0.0) for o, s in zip(outside, scores)])
    return F.try_divide(total, reduce(add, [o.cast("int") for o in outside]))


def bag_rows(rows: DataFrame, positives: int, seed: int) -> DataFrame:
    """The rows of one bag."""
    return bag_masks(rows, positives, 1, seed).where(in_bag(F.col("mask"), 0)).drop("mask")


def pu_bagging(
    data: Prepared,
    bags: int = Settings.pu_bags,
    depth: int = Settings.pu_depth,
    trees: int = 100,
    parallel: int = 4,
) -> list:
    """Positive-unlabelled bagging: each bag has all positives and as many unlabelled rows.

    Unlabelled rows are drawn by a hash of their key, so a lost task draws the same
    ones again. Membership of all bags is found once; where the unlabelled rows are no more than
    the positives, every bag has them all and none is drawn.
    """
    places = holds_places(data, trees)
    drawn_from = data.n > 2 * data.positives
    masked = bag_masks(data.rows, data.positives, bags, SEED).persist() if drawn_from else data.rows

    def bag(i: int):
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED + i, cacheNodeIds=places)
        return forest.fit(masked.where(in_bag(F.col("mask"), i)).drop("mask") if drawn_from else masked)

    try:
        with ThreadPoolExecutor(parallel) as pool:
            return list(pool.map(bag, range(bags)))
    finally:
        if drawn_from:
            masked.unpersist()


FAMILIES: dict[str, Callable[..., list]] = {
    "logistic_regression": logistic,
    "random_forest": random_forest,
    "hashed_forest": hashed_forest,
    "gradient_boosting": gradient_boosting,
    "bagging_pu": pu_bagging,
}


#: Models whose scores are one projection; the code of many more would be too long to compile.
MODELS_AT_ONCE = 32


def _probability(rows: DataFrame, models: Sequence, name: str) -> DataFrame:
    """Adds the mean probability of the models; all look at a row in the same pass.

    Models give their probability alone. Sums over some of many models are handed on by an
    explosion of one, so that they stay projections of their own.
    """
    own, total = rows.columns, []
    for first in range(0, len(models), MODELS_AT_ONCE):
        parts = []
        for i, model in enumerate(models[first : first + MODELS_AT_ONCE], first):
            parts.append(f"_{name}_{i}")
            rows = model.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(parts[-1]).transform(rows)
        total = [reduce(add, [*total, *[vector_to_array(c)[1] for c in parts]])]
        if first + MODELS_AT_ONCE < len(models):
            rows = rows.select(*own, F.explode(F.array(total[0])).alias(f"_{name}"))
            total = [F.col(f"_{name}")]
    return rows.select(*own, (total[0] / len(models)).alias(name))


@dataclass
class Fitted:
    """A fitted family and the preparation it needs."""

    models: list
    transformer: PipelineModel
    features: list[str]
    fill: dict[str, float] | None = None

    def vectors(self, cells: DataFrame) -> DataFrame:
        return self.transformer.transform(model_rows(cells, self.features)).select(
            *KEYS, "features", "label"
        )

    def score(self, cells: DataFrame) -> DataFrame:
        """Keys, y and p of every row (y is null where the label is unknown)."""
        return _probability(self.vectors(cells), self.models, "p").select(
            *KEYS, F.col("label").cast("int").alias("y"), "p"
        )

    def out_of_bag(self, cells: DataFrame) -> DataFrame:
        """Keys, y and p of the rows a bagged family was fitted on, each scored by the bags it isn't in.

        Positives are in every bag and have no such score.
        """
        rows = self.vectors(cells).where(F.col("label").isNotNull())
        positives = int(rows.agg(F.sum("label")).first()[0] or 0)
        scored, columns = bag_masks(rows, positives, len(self.models)), []
        for i, model in enumerate(self.models):
            scored, columns = _probability(scored, [model], f"p{i}"), [*columns, F.col(f"p{i}")]
        return scored.select(*KEYS, F.col("label").cast("int").alias("y"), out_of_bag_mean(F.col("mask"), columns).alias("p"))

    def importances(self) -> list[tuple[str, float]]:
        """Features by importance (trees) or by size of coefficient (logistic)."""
        totals = [0.0] * len(self.features)
        for model in self.models:
            values = (
                model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
            )
            totals = [t + abs(float(v)) for t, v in zip(totals, values.toArray())]
        ranked = zip(self.features, [t / len(self.models) for t in totals])
        return sorted(ranked, key=lambda kv: (-kv[1], kv[0]))


def fit(cells: DataFrame, family: str, **params) -> Fitted:
    """Fits one family on a labelled panel."""
    data = Prepared.of(cells)
    try:
        return Fitted(FAMILIES[family](data, **params), data.transformer, data.features, data.fill)
    finally:
        data.release()


def fit_each(cells: DataFrame, families: Sequence[str]) -> dict[str, Fitted]:
    """Fits several families, with their published parameters, on rows prepared once."""
    data = Prepared.of(cells)
    try:
        return {
            family: Fitted(FAMILIES[family](data), data.transformer, data.features, data.fill)
            for family in families
        }
    finally:
        data.release()


def baseline_scores(cells: DataFrame, train: DataFrame, seed: int = SEED) -> DataFrame:
    """Stratified guess: 1 with the prevalence of the training rows, fixed by the row key."""
    prevalence = train.agg(F.avg(TARGET)).scalar()
    guess = (hash_unit(KEYS, seed) < prevalence).cast("double")
    return cells.select(*KEYS, F.col(TARGET).alias("y"), guess.alias("p"))


#: Rows of one task of a fit among many: a step over them outlasts the start of its task.
ROWS_PER_TASK = 1 << 20


def fit_tasks(rows: DataFrame, n: int) -> tuple[int, int]:
    """Tasks that a fit among many needs for ``n`` rows, and how many such fits fill the cores."""
    tasks = max(1, math.ceil(n / ROWS_PER_TASK))
    return tasks, max(1, rows.sparkSession.sparkContext.defaultParallelism // tasks)


def _fold_metrics(
    sides: dict[str, DataFrame],
    fold: int,
    fill: dict[str, float],
    family: str,
    draws: Sequence[dict],
    pool: ThreadPoolExecutor,
    per_task: int | None,
) -> DataFrame:
    """Metrics of all parameter draws on one fold: prepared once, scored in one pass."""
    data = Prepared.of(sides["train"], fill, per_task)
    try:
        fitted = list(pool.map(lambda p: FAMILIES[family](data, **p), draws))
    finally:
        data.release()
    scored = Fitted([], data.transformer, data.features).vectors(sides["val"])
    for i, models in enumerate(fitted):
        scored = _probability(scored, models, f"p{i}")
    columns = [f"p{i}" for i in range(len(draws))]
    long = scored.select(
        F.col("label").cast("int").alias("y"),
        F.posexplode(F.array(*columns)).alias("iteracion", "p"),
    )
    m = full_metrics(long, ["iteracion"])
    return m.select(
        F.lit(fold).alias("fold"),
        "iteracion",
        F.col("auc_roc_full").alias("auc_roc"),
        F.col("f1_full").alias("f1"),
        F.col("precision_full").alias("precision"),
        F.col("recall_full").alias("recall"),
    )


def fold_preparation(cells: DataFrame, folds: int) -> tuple[dict[int, int], dict[int, dict[str, float]]]:
    """Training rows of the folds with both classes on both sides, and the medians of every training side.

    One grouped pass for all folds each; a few rows for each fold come to the driver.
    """
    placed = cells.join(F.broadcast(fold_table(cells, folds)), "week_start")
    seen = placed.groupBy("fold", "side").agg(F.min(TARGET).alias("a"), F.max(TARGET).alias("b"), F.count(TARGET).alias("n")).collect()
    whole = [r["fold"] for r in seen if r["a"] == 0 and r["b"] == 1]
    rows = {r["fold"]: r["n"] for r in seen if r["side"] == "train"}
    train = placed.where((F.col("side") == "train") & F.col(TARGET).isNotNull())
    long = unpivoted(train, [f for f in MODEL_FEATURES if f in cells.columns], ["fold"])
    fills: dict[int, dict[str, float]] = {}
    for r in exact_quantiles(long, "value", {"median": 0.5}, ["fold", "feature"]).collect():
        fills.setdefault(r["fold"], {})[r["feature"]] = r["median"]
    return {f: rows[f] for f in whole if whole.count(f) == 2}, fills


def search_folds(
    cells: DataFrame, family: str, draws: Sequence[dict], folds: int = 4, parallel: int = 4
) -> DataFrame:
    """Metrics of every (fold, draw). Folds with one class on a side are skipped.

    Spark's own fold columns would train on later weeks too, hence these jobs by fold; they run
    side by side. A logistic fit is dozens of short steps over the same rows. Where there are many
    fits, each has only as many tasks as its rows need and the cores are filled by other fits:
    the start of tasks would cost more than the steps. Fits that fill the cores alone run one by one.
    """
    whole, fills = fold_preparation(cells, folds)
    todo = [(fold, sides) for fold, sides in fold_sides(cells, folds).items() if fold in whole]
    abreast, at_once, per_task = max(1, len(todo)), parallel * max(1, len(todo)), None
    if family == "logistic_regression" and len(draws) > 1:
        at_once, per_task = fit_tasks(cells, max(whole.values(), default=1))[1], ROWS_PER_TASK
        abreast = min(abreast, at_once)
    with ThreadPoolExecutor(abreast) as pool, ThreadPoolExecutor(at_once) as fits:
        jobs = [pool.submit(_fold_metrics, sides, fold, fills[fold], family, draws, fits, per_task) for fold, sides in todo]
        done = [job.result() for job in jobs]
    if not done:
        schema = "fold int, iteracion int, " + ", ".join(f"{m} double" for m in CV_METRICS)
        return cells.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, done)


def panel_cv(cells: DataFrame, family: str, folds: int = 4, **params) -> DataFrame:
    """Metrics of each chronological fold: (fold, auc_roc, f1, precision, recall)."""
    return search_folds(cells, family, [params], folds).drop("iteracion")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return fold_summary(per_fold, CV_METRICS)


def draw_parameters(family: str, draws: int, seed: int = SEED) -> list[dict]:
    """Random settings from the published ranges."""
    rng = random.Random(seed)
    spaces = {
        "logistic_regression": lambda: {"c": 0.01 + 10 * rng.random()},
        "random_forest": lambda: {
            "trees": rng.randrange(50, 300),
            "depth": rng.randrange(3, 12),
            "min_leaf": rng.randrange(1, 20),
        },
        "bagging_pu": lambda: {"bags": rng.randrange(10, 30), "depth": rng.randrange(3, 8)},
    }
    return [spaces[family]() for _ in range(draws)]


def param_search(
    cells: DataFrame, family: str, draws: int = 20, folds: int = 4, parallel: int = 4
) -> DataFrame:
    """Mean AUC and recall over the folds of every random draw, best first."""
    settings = draw_parameters(family, draws)
    names = [",".join(f"{k}={v:.6g}" for k, v in sorted(p.items())) for p in settings]
    results = search_folds(cells, family, settings, folds, parallel)
    return (
        results.groupBy("iteracion")
        .agg(F.avg("auc_roc").alias("auc_roc_mean"), F.avg("recall").alias("recall_mean"))
        .withColumn("params", F.get(F.array(*[F.lit(n) for n in names]), F.col("iteracion")))
        .orderBy(F.desc("auc_roc_mean"), "iteracion")
    )


def full_grid_eval(
    train: DataFrame,
    full: DataFrame,
    family: str,
    train_until: int | None,
    first: int | None = None,
    last: int | None = None,
    **params,
) -> DataFrame:
    """Metrics on the unfiltered grid of some years by a model that saw nothing after ``train_until``.

    ``train_until=None`` trains on every year, as the published flow does.
    """
    seen = train if train_until is None else year_slice(train, last=train_until)
    return full_metrics(fit(seen, family, **params).score(year_slice(full, first, last)))


def holdout_gap(
    train: DataFrame, full: DataFrame, family: str, year: int, **params
) -> DataFrame:
    """Trained before a year: metrics from that year on selected rows and on the full grid."""
    fitted = fit(year_slice(train, last=year - 1), family, **params)
    both = reduce(
        DataFrame.unionByName,
        [
            fitted.score(year_slice(side, first=year)).select(F.lit(name).alias("grid"), "y", "p")
            for name, side in (("seleccionado", train), ("completo", full))
        ],
    )
    measured = full_metrics(both, ["grid"])
    of = lambda name, c: F.max(F.when(F.col("grid") == name, F.col(c)))
    inner, outer = of("seleccionado", "auc_roc_full"), of("completo", "auc_roc_full")
    return measured.agg(
        inner.alias("auc_seleccionado"),
        outer.alias("auc_completo"),
        (100 * (inner - outer) / inner).alias("degradacion_pct"),
        of("completo", "recall_full").alias("recall_completo"),
        of("completo", "precision_full").alias("precision_completo"),
    )
