"""Steps that must stay small per task or cheap per fit, whatever the size of the tables."""

import inspect
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import timeseries as ts
from panelwatch.plans import models as mo
from panelwatch.plans import pipeline as pl
from panelwatch.plans import queries


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    rows = [
        (date(2020, 1, 6) + timedelta(days=7 * w), u, float(rng.normal()), 10.0 * u, int(rng.random() < 0.2 + 0.02 * u))
        for w in range(40)
        for u in range(20)
    ]
    return spark.createDataFrame(rows, "week_start date, unit_id long, precip_acum_14d double, up_area double, deslizamiento int")


def test_fits_of_a_search_have_no_more_tasks_than_their_rows_need(train, monkeypatch):
    widths, fit = [], mo.FAMILIES["logistic_regression"]

    def watched(data, **params):
        widths.append(data.rows.rdd.getNumPartitions())
        return fit(data, **params)

    monkeypatch.setitem(mo.FAMILIES, "logistic_regression", watched)
    found = mo.param_search(train, "logistic_regression", draws=3, folds=2).collect()
    assert widths == [1] * 6
    apart = {}
    for i, params in enumerate(mo.draw_parameters("logistic_regression", 3)):
        apart[i] = mo.panel_cv(train, "logistic_regression", 2, **params).agg(F.avg("auc_roc"), F.avg("recall")).first()
    for r in found:
        assert (r.auc_roc_mean, r.recall_mean) == pytest.approx(tuple(apart[r.iteracion]), abs=1e-9)


def test_days_of_many_series_are_spread_over_many_tasks(spark):
    days = [(u, date(2021, 1, 4) + timedelta(days=i), float(u + i)) for u in range(200) for i in (0, 3, 100)]
    daily = spark.createDataFrame(days, "unit_id long, fecha date, value double")
    filled = ts.interpolate_daily(daily, ["unit_id"])
    assert filled.count() == 200 * 101 and filled.where("abs(value - unit_id - datediff(fecha, date'2021-01-04')) > 1e-9").isEmpty()
    largest = filled.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest <= 200 * 101 / 20
    soil = ts.weekly_soil_features(daily.withColumnRenamed("value", "soil_moisture_m3m3"), ["unit_id"])
    alone = ts.weekly_soil_features(daily.where("unit_id = 7").withColumnRenamed("value", "soil_moisture_m3m3"), ["unit_id"])
    assert sorted(soil.where("unit_id = 7").collect()) == sorted(alone.collect())


@pytest.mark.parametrize("positives", [1, 700, 5000])
def test_running_totals_of_bags_see_few_hashes(spark, monkeypatch, positives):
    rows = spark.range(4000).select(
        F.lit(date(2021, 1, 4)).alias("week_start"), F.col("id").alias("unit_id"), F.lit(0.0).alias("label")
    )
    seen, running = [], mo.cumulative_by_value

    def watched(df, *rest):
        seen.append(df.count())
        return running(df, *rest)

    monkeypatch.setattr(mo, "cumulative_by_value", watched)
    masked = mo.bag_masks(rows, positives, 2).select("unit_id", "mask").collect()
    assert seen[0] <= 2 * 4000 / 100
    codes = rows.select("unit_id", *[mo.hash_code(mo.KEYS, mo.SEED + i).alias(f"c{i}") for i in range(2)]).collect()
    for i in range(2):
        first = {r.unit_id for r in sorted(codes, key=lambda r: (r[f"c{i}"], r.unit_id))[:positives]}
        assert {r.unit_id for r in masked if r["mask"] >> i & 1} == first


def test_training_rows_are_chosen_from_the_stored_panel(train):
    asked = []

    def positive(kept):
        asked.extend(kept.inputFiles())
        return kept.where("deslizamiento = 1")

    full, chosen = pl.store_panels(train, positive)
    assert set(asked) == set(full.inputFiles())
    assert sorted(full.collect()) == sorted(train.collect())
    assert sorted(chosen.collect()) == sorted(train.where("deslizamiento = 1").collect())


def test_families_share_one_preparation(train, monkeypatch):
    prepared, of = [], mo.Prepared.of
    monkeypatch.setattr(mo.Prepared, "of", staticmethod(lambda *a: prepared.append(of(*a)) or prepared[-1]))
    for family in ("logistic_regression", "random_forest", "gradient_boosting"):
        monkeypatch.setitem(mo.FAMILIES, family, lambda data, own=mo.FAMILIES["logistic_regression"]: own(data))
    fitted = mo.fit_each(train, ("logistic_regression", "random_forest", "gradient_boosting"))
    assert len(prepared) == 1 and list(fitted) == ["logistic_regression", "random_forest", "gradient_boosting"]
    alone = mo.fit(train, "logistic_regression").importances()
    for found in fitted.values():
        assert [f for f, _ in found.importances()] == [f for f, _ in alone]
        assert [v for _, v in found.importances()] == pytest.approx([v for _, v in alone])


def test_a_report_compares_every_family_with_published_parameters(monkeypatch):
    asked = {}

    def report(train, full, families=None, **rest):
        asked.update(families or dict.fromkeys(mo.FAMILIES, {}))
        raise InterruptedError

    monkeypatch.setattr(queries, "_stored", lambda spark, d: (None, None))
    monkeypatch.setattr(queries.pipeline, "training_report", report)
    with pytest.raises(InterruptedError):
        queries.training_report(None, None)
    assert asked == dict.fromkeys(mo.FAMILIES, {})
    trees = {f: inspect.signature(mo.FAMILIES[f]).parameters["trees"].default for f in ("random_forest", "hashed_forest")}
    assert set(trees.values()) == {mo.Settings.forest_trees}


def test_scores_of_many_models_are_several_projections(train):
    fitted = mo.fit(train, "hashed_forest", trees=2 * mo.MODELS_AT_ONCE + 1, depth=2)
    rows = fitted.vectors(train).persist()
    found = mo._probability(rows, fitted.models, "p")
    assert found.columns == [*rows.columns, "p"]
    apart = [m.transform(rows).select(*mo.KEYS, mo.vector_to_array("probability")[1].alias("p")) for m in fitted.models[:: mo.MODELS_AT_ONCE]]
    some = mo._probability(rows, fitted.models[:: mo.MODELS_AT_ONCE], "p")
    by_hand = mo.reduce(lambda a, b: a.union(b), apart).groupBy(*mo.KEYS).agg(F.avg("p").alias("q"))
    assert some.join(by_hand, mo.KEYS).where("abs(p - q) < 1e-12").count() == rows.count()
    assert found.where("p > 0 and p < 1").count() == rows.count()
    # The optimizer keeps a step for each slice of models.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 2


def test_bags_that_hold_every_row_draw_none(train, monkeypatch):
    mostly = train.withColumn("deslizamiento", 1 - F.col("deslizamiento"))
    drawn = []
    masks = mo.bag_masks
    monkeypatch.setattr(mo, "bag_masks", lambda *a: drawn.append(1) or masks(*a))
    for rows, times in ((mostly, 0), (train, 1)):
        data, before = mo.Prepared.of(rows), len(drawn)
        assert (data.n > 2 * data.positives) == bool(times)
        models = mo.pu_bagging(data, bags=2, depth=2, trees=3)
        assert len(models) == 2 and len(drawn) - before == times
        if not times:
            held = masks(data.rows, data.positives, 2)
            assert held.where("mask <> 3").isEmpty() and held.count() == data.n
        data.release()


def test_held_places_give_the_same_trees(train, monkeypatch):
    data, found = mo.Prepared.of(train), []
    for most in (0, 1 << 28):
        monkeypatch.setattr(mo, "PLACES_HELD", most)
        forest = mo.random_forest(data, trees=4)[0]
        assert forest.getCacheNodeIds() == bool(most)
        found.append(forest.toDebugString.split("\n", 1)[1])
    data.release()
    assert found[0] == found[1]


def test_hashed_trees_have_as_few_tasks_as_their_rows_need(train, monkeypatch):
    widths, fit = [], mo.RandomForestClassifier.fit
    monkeypatch.setattr(mo.RandomForestClassifier, "fit", lambda self, rows: widths.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    mo.fit(train, "hashed_forest", trees=3, depth=2)
    assert widths == [1] * 3
