import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwatch.operators import drift as dr
from panelwatch.operators import metrics as me
from panelwatch.settings import Settings


def scored(spark, ys, ps):
    return spark.createDataFrame(list(zip(ys, map(float, ps))), "y int, p double")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"y": rng.integers(0, 2, 800), "g": rng.integers(0, 3, 800)})
    p["p"] = np.where(rng.random(800) < 0.33, 0.5, np.round(rng.random(800) * 0.6 + p.y * 0.3, 2))
    return spark.createDataFrame(p), p


def pair_auc(p):
    pos, neg = p[p.y == 1].p.values, p[p.y == 0].p.values
    d = pos[:, None] - neg[None, :]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size


def test_ties_count_half(spark):
    assert me.roc_auc(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.4, 0.8])).first().auc_roc == 0.875


def test_auc_equals_all_pairs_and_the_library(sample):
    df, p = sample
    got = me.roc_auc(df).first().auc_roc
    assert got == pytest.approx(pair_auc(p), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="v", labelCol="y", numBins=0)
    vectors = df.withColumn("v", array_to_vector(F.array(1 - F.col("p"), "p")))
    assert got == pytest.approx(evaluator.evaluate(vectors), abs=1e-9)


def test_full_metrics_by_key(sample):
    df, p = sample
    got = me.full_metrics(df, ["g"]).toPandas().set_index("g").sort_index()
    for g, part in p.groupby("g"):
        hit = part.p >= 0.5
        tp, fp = (hit & (part.y == 1)).sum(), (hit & (part.y == 0)).sum()
        assert got.auc_roc_full[g] == pytest.approx(pair_auc(part))
        assert got.recall_full[g] == pytest.approx(tp / part.y.sum())
        assert got.precision_full[g] == pytest.approx(tp / (tp + fp))
        assert got.n_total_full[g] == len(part)


def test_one_class_has_no_auc(spark):
    assert me.roc_auc(scored(spark, [0, 0], [0.1, 0.2])).first().auc_roc is None


def test_no_predicted_positives_gives_zeros(spark):
    row = me.binary_metrics(scored(spark, [0, 1], [0.1, 0.2])).first()
    assert (row.recall, row.precision, row.f1, row.fpr) == (0.0, 0.0, 0.0, 0.0)


def test_pr_area(sample):
    df, p = sample
    t = p.groupby("p").y.agg(["sum", "count"]).sort_index(ascending=False).cumsum()
    recall = np.r_[0.0, t["sum"] / p.y.sum()]
    precision = np.r_[1.0, t["sum"] / t["count"]]
    want = ((recall[1:] - recall[:-1]) * (precision[1:] + precision[:-1]) / 2).sum()
    assert me.pr_auc(df).first().pr_auc == pytest.approx(want)


def test_histogram_counts_the_last_edge(spark):
    got = {r.desde: r.n for r in me.score_histogram(scored(spark, [0, 1, 1], [0.0, 0.3, 1.0])).collect()}
    assert got == {0.0: 1, 0.3: 1, 0.9: 1}


def test_rank_statistics(sample):
    df, p = sample
    assert me.spearman(df, ["p"], "y").first().rho == pytest.approx(p.p.rank().corr(p.y.rank()))
    got = me.mann_whitney(df, "p", "y").first()
    n0, n1 = (p.y == 0).sum(), (p.y == 1).sum()
    assert got.u == pytest.approx((1 - pair_auc(p)) * n0 * n1)
    assert 0 <= got.p_value < 1e-6
    r = me.point_biserial(df, ["p"], "y").first()
    assert r.r == pytest.approx(p.p.corr(p.y)) and r.n == 800 and r.p_value < 1e-6
    pairs = {(x.a, x.b): x.r for x in me.pearson_matrix(df, ["p", "y", "g"]).collect()}
    assert pairs[("p", "g")] == pytest.approx(p.p.corr(p.g))


def test_a_constant_label_has_no_correlation(spark):
    rows = [(float(i), float(i % 3), 1, 5.0 if i else None) for i in range(6)]
    df = spark.createDataFrame(rows, "p double, q double, y int, k double")
    pairs = {(x.a, x.b): x.r for x in me.pearson_matrix(df, ["p", "q", "y", "k"]).collect()}
    assert pairs[("p", "y")] is None and pairs[("y", "k")] is None and pairs[("p", "q")] == pytest.approx(0.478091, abs=1e-6)
    got = me.significant(me.point_biserial(df, ["p", "k"], "y")).collect()
    assert {(r.feature, r.n, r.r, r.p_value, r.significativa) for r in got} == {("p", 6, None, None, None), ("k", 5, None, None, None)}
    mixed = me.significant(me.point_biserial(df, ["k", "p"], "q")).collect()
    assert {r.feature: r.orden for r in mixed} == {"p": 1, "k": 2} and {r.feature: r.r for r in mixed}["k"] is None


def test_a_score_is_computed_once_for_each_row(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(i):
        seen.add(1)
        return i / 100

    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"), slow("id").alias("p"))
    row = me.full_metrics(df).first()
    assert row.n_total_full == 100 and row.auc_roc_full == pytest.approx(0.51)
    assert seen.value == 100


def test_normal_tail(spark):
    zs = [0.0, 1.0, 1.959964, 3.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double").select(me.normal_two_sided(F.col("z")))
    assert [r[0] for r in df.collect()] == pytest.approx([1.0, 0.317311, 0.05, 0.0027], abs=1e-5)


def test_promotion(spark):
    rows = [("a", 0.61, 0.0061), ("b", 0.5, 0.01), ("c", 0.4, 0.001), ("base", 0.9, 0.9)]
    df = spark.createDataFrame(rows, "modelo string, auc_roc_full double, precision_full double")
    got = {r.modelo: (r.promovido, r.razon) for r in me.promotion(df, Settings()).collect()}
    assert got["a"] == (True, "") and got["b"] == (False, "AUC 0.5000 < 0.6")
    assert got["c"][1] == "AUC 0.4000 < 0.6 | Precision 0.0010 < 0.006"
    assert me.best_candidate(df, "auc_roc_full", ["base"]).first().modelo == "a"


def feature(spark, values, name="f"):
    return spark.createDataFrame([(name, float(v)) for v in values], "feature string, value double")


def test_ks_extremes_and_symmetry(spark):
    a, b = range(20), range(100, 120)
    same = dr.ks_test(feature(spark, a), feature(spark, a)).first()
    assert same.estadistico_ks == 0 and same.p_value == 1.0 and not same.drift
    apart = dr.ks_test(feature(spark, a), feature(spark, b)).first()
    assert apart.estadistico_ks == 1 and apart.p_value < 1e-6 and apart.drift
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=300), rng.normal(0.2, size=200)
    xy = dr.ks_test(feature(spark, x), feature(spark, y)).first().estadistico_ks
    yx = dr.ks_test(feature(spark, y), feature(spark, x)).first().estadistico_ks
    grid = np.r_[x, y]
    want = max(abs((x <= v).mean() - (y <= v).mean()) for v in grid)
    assert xy == pytest.approx(want) == yx


def test_few_recent_rows_are_skipped(spark):
    tested = dr.ks_test(feature(spark, range(20)), feature(spark, range(9)))
    assert tested.isEmpty()
    row = dr.drift_summary(tested).first()
    assert row.drift_detectado is False and row.features_con_drift == ""


def test_reference_statistics(spark):
    rows = [(w, u, float(w * 100 + u)) for w in range(30) for u in range(50)]
    df = spark.createDataFrame(rows, "week_start int, unit_id int, x double")
    stats = dr.reference_statistics(df, ["x"]).first()
    values = np.array([r[2] for r in rows])
    assert stats.n == 1500 and stats.std == pytest.approx(values.std())
    assert stats.p25 == pytest.approx(np.percentile(values, 25))


def test_student_p_values(spark):
    """Against the tail of Student's density, integrated by Simpson's rule."""
    import math

    from panelwatch.functions.distributions import correlation_p

    def tail(r, n, steps=20_000):
        def area(low):
            h = (math.pi / 2 - low) / steps
            weights = (1 if i in (0, steps) else 4 if i % 2 else 2 for i in range(steps + 1))
            return sum(w * max(math.cos(low + i * h), 0.0) ** (n - 3) for i, w in enumerate(weights)) * h

        return area(math.asin(abs(r))) / area(0.0)

    rows = [(r, n) for n in (4, 10, 11, 50, 400) for r in (0.0, 0.01, -0.3, 0.6, -0.95)] + [(0.02, 15_000), (0.01, 30_000)]
    df = spark.createDataFrame([*rows, (1.0, 10), (0.5, 2), (None, 10)], "r double, n long")
    got = [x.p for x in df.select(correlation_p(F.col("r"), F.col("n")).alias("p")).collect()]
    assert got[:-3] == pytest.approx([tail(*x) for x in rows], abs=1e-6)
    assert got[-3:] == [0.0, None, None]


def test_drift_state_grows_by_weeks(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(f"2020-{1 + w // 4:02d}-{1 + 7 * (w % 4):02d}", float(round(v, 1)), float(w)) for w in range(12) for v in rng.normal(w / 6, 1, 60)]
    cells = spark.createDataFrame(rows, "day string, x double, z double").selectExpr("cast(day as date) as week_start", "x", "z")
    path = str(tmp_path / "state")
    for upto in ("2020-02-01", "2020-03-01", "2021-01-01"):
        dr.append_state(cells.where(F.col("week_start") < upto), ["x", "z"], path)
        state = dr.read_state(spark, path)
    split = F.col("week_start") < "2020-02-15"
    old, new = (dr.merge_states(state.where(c)) for c in (split, ~split))
    plain = dr.ks_test(*(dr.unpivot_features(cells.where(c), ["x", "z"]) for c in (split, ~split)))
    key = lambda r: r.feature
    assert sorted(dr.ks_of_states(old, new).collect(), key=key) == sorted(plain.collect(), key=key)
    twice = dr.merge_states(old, new)
    assert twice.agg(F.sum("n")).first()[0] == 2 * 720
