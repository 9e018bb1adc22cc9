"""Whole jobs on small data: data job, training, scoring, incremental forms."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.plans import linear as li
from panelwatch.plans import models as mo
from panelwatch.plans import pipeline as pl
from panelwatch.settings import MODEL_FEATURES, Settings
from panelwatch.sources.landing import read_panel
from panelwatch.streaming import jobs

SETTINGS = Settings(first_year=2020, last_year=2021, min_positives=5, min_coverage=0.3)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A region where events follow wet weeks in units with a large area."""
    rng = np.random.default_rng(7)
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(731)]
    rain = [float(v) for v in rng.gamma(0.6, 12, len(days)).round(1)]
    daily = spark.createDataFrame(list(zip(days, rain)), "fecha date, precip_mm double")
    units = spark.createDataFrame(
        [(u, 100.0 * u, 50.0 + u, float(u % 5), 1 + u % 4) for u in range(1, 25)],
        "unit_id long, up_area double, sub_area double, dist_main double, ord int",
    )
    fortnight = np.convolve(rain, np.ones(14))[: len(rain)]
    events = [
        (u, days[i])
        for i in range(20, len(days), 3)
        for u in range(8, 25)
        if fortnight[i - 7] > 110 and rng.random() < u / 150
    ]
    log = spark.createDataFrame(events, "unit_id long, fecha date")
    folder = str(tmp_path_factory.mktemp("panel"))
    pl.run_data_job(log, units, daily, folder, SETTINGS)
    full, train = pl.read_stored(spark, folder)
    return full, train, len(events), folder


def test_stored_panels(spark, stored):
    full, train, _, _ = stored
    weeks = full.select("week_start").distinct().count()
    assert full.count() == weeks * 24 and weeks == 105
    positives = full.where("deslizamiento = 1")
    kept = train.where("deslizamiento = 1").select("week_start", "unit_id")
    assert positives.count() == kept.count() > 20
    assert train.where("deslizamiento = 0").agg(F.max("up_area")).first()[0] <= 675.0


def test_only_one_row_per_key(stored):
    full = stored[0]
    assert full.groupBy("week_start", "unit_id").count().where("count > 1").isEmpty()


def test_pipeline_learns_and_leaves_out_null_features(stored):
    full, train, *_ = stored
    fitted = mo.fit(train, "random_forest", trees=20)
    assert "soil_moisture_14d" not in fitted.features
    assert fitted.features == [f for f in MODEL_FEATURES if f != "soil_moisture_14d"]
    ranked = fitted.importances()
    assert len(ranked) == len(fitted.features) and ranked[0][1] >= ranked[-1][1]
    scored = fitted.score(train)
    assert scored.where("p < 0 or p > 1 or p is null").isEmpty()
    assert mo.full_metrics(scored).first().auc_roc_full > 0.9


def test_label_derived_features_are_refused(stored):
    with pytest.raises(ValueError):
        mo.model_rows(stored[1], ["n_eventos"])


def test_bags_are_reproducible_whatever_the_partitions(stored):
    full, train, *_ = stored
    scores = [
        mo.fit(part, "bagging_pu", bags=2, trees=5).score(full).agg(F.sum("p")).first()[0]
        for part in (train, train.repartition(7, "unit_id"))
    ]
    again = mo.fit(train, "bagging_pu", bags=2, trees=5).score(full).agg(F.sum("p")).first()[0]
    assert scores[0] == pytest.approx(again, abs=1e-9)
    assert scores[1] == pytest.approx(scores[0], rel=0.2)


def test_baseline_guesses_at_the_prevalence(stored):
    full, train, *_ = stored
    row = mo.baseline_scores(full, train).agg(F.avg("p"), F.count("*")).first()
    share = train.agg(F.avg("deslizamiento")).first()[0]
    assert row[0] == pytest.approx(share, abs=4 * (share / row[1]) ** 0.5)
    assert mo.full_metrics(mo.baseline_scores(full, train)).first().auc_roc_full == pytest.approx(0.5, abs=0.1)


def test_cross_validation_and_search(stored):
    train = stored[1]
    cv = mo.panel_cv(train, "logistic_regression").toPandas()
    assert set(cv.columns) == {"fold", "auc_roc", "f1", "precision", "recall"} and 1 <= len(cv) <= 4
    assert cv.auc_roc.between(0, 1).all()
    found = mo.param_search(train, "logistic_regression", draws=2, folds=3).toPandas()
    assert len(found) == 2 and found.auc_roc_mean.is_monotonic_decreasing
    assert mo.draw_parameters("bagging_pu", 3) == mo.draw_parameters("bagging_pu", 3)


def test_folds_with_one_class_are_skipped(stored):
    none = stored[1].withColumn("deslizamiento", F.lit(0))
    cv = mo.panel_cv(none, "logistic_regression")
    assert cv.isEmpty()
    assert mo.cv_summary(cv).first().auc_roc_mean == 0.0


def test_strict_holdout(stored):
    full, train, *_ = stored
    row = mo.holdout_gap(train, full, "logistic_regression", 2021).first()
    assert row.degradacion_pct == pytest.approx(100 * (1 - row.auc_completo / row.auc_seleccionado))


def test_report_and_choice(stored):
    full, train, *_ = stored
    report = pl.training_report(
        train, full, {"logistic_regression": {}, "random_forest": {"trees": 5}}, 2020, SETTINGS
    )
    rows = report.toPandas()
    assert len(rows) == 2 and pl.pick_model(report) == rows.sort_values("auc_roc_full").modelo.iloc[-1]


def test_scoring_a_week(stored):
    full, train, *_ = stored
    fitted = mo.fit(train, "logistic_regression")
    stamp = F.lit("2022-01-03").cast("timestamp")
    rows, document = pl.score_week(fitted, full, stamp)
    assert rows.count() == 24 and document.count() == 25
    assert rows.first().week_start == date(2021, 12, 27)
    past, _ = pl.score_week(fitted, full, stamp, "2020-07-06/2020-07-12")
    assert {r.week_start for r in past.collect()} == {date(2020, 7, 6)}
    assert pl.historic_week(full, "nonsense").isEmpty()


def test_events_are_placed_end_to_end(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    polygons = spark.createDataFrame([(5, ring)], "unit_id long, ring array<struct<x:double,y:double>>")
    places = spark.createDataFrame([("sanpedro", 1.0, 1.0)], "place string, lon double, lat double")
    raw = spark.createDataFrame(
        [(1, "2020-03-01", "ANTIOQUIA", "San Pedro", "Deslizamiento"), (2, "2020-03-01", "Antioquia", "San Pedro", "Sismo"),
         (3, "2018-03-01", "ANTIOQUIA", "San Pedro", "Derrumbe"), (4, "x", "ANTIOQUIA", "San Pedro", "Derrumbe")],
        "id long, fecha string, departamento string, municipio string, evento string",
    )
    got = pl.place_events(raw, places, polygons, "antioquia", ("deslizamiento", "derrumbe"), SETTINGS)
    assert [(r.id, r.unit_id) for r in got.collect()] == [(1, 5)]


def test_streamed_scores_equal_the_batch(spark, stored, tmp_path):
    full, train, _, folder = stored
    fitted = mo.fit(train, "logistic_regression")
    source = f"{folder}/full"
    stream = spark.readStream.schema(read_panel(spark, source).schema).option("maxFilesPerTrigger", 3).parquet(source)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):  # the second run finds nothing new
        jobs.stream_score(fitted, stream, out, checkpoint)
    streamed = spark.read.parquet(out)
    want = pl.predictions(fitted.score(full), F.current_timestamp())
    columns = ["week_start", "unit_id", "probabilidad_deslizamiento", "nivel_riesgo"]
    assert streamed.count() == full.count()
    assert streamed.select(columns).exceptAll(want.select(columns)).isEmpty()


def test_streamed_counts_over_two_landings(spark, tmp_path):
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    schema = "ts timestamp, p double"

    def land(*rows):
        df = spark.createDataFrame(rows, "ts string, p double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(log)

    def run():
        jobs.stream_band_counts(spark.readStream.schema(schema).parquet(log), out, checkpoint)
        return {(str(r.dia), r.nivel_riesgo): r.n for r in jobs.current_counts(spark, out).collect()}

    land(("2021-01-05 01:00:00", 0.9), ("2021-01-05 02:00:00", 0.1))
    assert run() == {("2021-01-05", "Alto"): 1, ("2021-01-05", "Bajo"): 1}
    land(("2021-01-05 03:00:00", 0.7), ("2021-01-06 03:00:00", 0.4))
    assert run() == {("2021-01-05", "Alto"): 2, ("2021-01-05", "Bajo"): 1, ("2021-01-06", "Medio"): 1}
    land(("2021-01-02 03:00:00", 0.7))  # later than the allowed day: left out
    assert ("2021-01-02", "Alto") not in run()


def test_hashed_forests_do_not_depend_on_the_layout(spark, stored):
    train = stored[1]
    rows = train.orderBy("week_start", "unit_id").limit(1500).cache()
    one = mo.fit(rows.repartition(1), "hashed_forest", trees=2, depth=4)
    other = mo.fit(rows.repartition(7, "unit_id"), "hashed_forest", trees=2, depth=4)
    score = lambda f: [(r.week_start, r.unit_id, r.p) for r in f.score(rows).orderBy("week_start", "unit_id").collect()]
    assert score(one) == score(other)
    assert len({p for _, _, p in score(one)}) > 1


def test_out_of_bag(spark, stored):
    train = stored[1]
    rows = train.orderBy("week_start", "unit_id").limit(1500).cache()
    fitted = mo.fit(rows, "bagging_pu", bags=3, trees=3, depth=3)
    found = fitted.out_of_bag(rows).collect()
    masks = {
        (r.week_start, r.unit_id): r.mask
        for r in mo.bag_masks(mo.model_rows(rows, ["up_area"]), sum(r.y for r in found), 3).collect()
    }
    positives = sum(r.y for r in found)
    for i in range(3):
        assert sum(m >> i & 1 for m in masks.values()) == 2 * positives
    assert all((r.p is None) == (masks[r.week_start, r.unit_id] == 7) for r in found)
    assert all(r.p is None for r in found if r.y == 1) and any(r.p is not None for r in found)


def test_coefficient_table_scores_like_the_model(spark, stored):
    full, train, *_ = stored
    fitted = mo.fit(train, "logistic_regression")
    table = li.of_fitted(spark, fitted)
    rows = li.score(full, table, fitted.features).join(fitted.score(full).withColumnRenamed("p", "q").drop("y"), mo.KEYS)
    assert rows.where(F.abs(F.col("p") - F.col("q")) > 1e-6).isEmpty() and rows.count() == full.count()


def test_certificate_tells_the_optimum(spark, stored):
    train = stored[1]
    fitted = mo.fit(train, "logistic_regression")
    rows = mo.model_rows(train, fitted.features).where(F.col("label").isNotNull())
    n, pos = rows.count(), rows.where("label = 1").count()
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos))))
    table, penalty = li.of_fitted(spark, fitted), 1 / (SETTINGS.logistic_c * n)
    good = li.certificate(weighted, table, fitted.features, penalty).first()
    assert good.n == n and good.peso == pytest.approx(n)
    assert good.gradiente < 1e-3 and good.perdida < good.perdida_cercana
    moved = table.withColumn("weight", F.col("weight") + F.when(F.col("feature") == "up_area", 0.5).otherwise(0.0))
    assert li.certificate(weighted, moved, fitted.features, penalty).first().gradiente > 3e-3


def test_standardisation_by_fold_is_that_of_its_rows(spark, stored):
    train = stored[1].withColumn("fold", F.col("unit_id") % 2)
    together = {(r.fold, r.feature): r[2:] for r in li.standardisation(train, ["up_area", "precip_acum_7d"], ["fold"]).collect()}
    for k in (0, 1):
        alone = li.standardisation(train.where(F.col("fold") == k), ["up_area", "precip_acum_7d"]).collect()
        assert {(k, r.feature): pytest.approx(r[1:]) for r in alone} == {x: v for x, v in together.items() if x[0] == k}
