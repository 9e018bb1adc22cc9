from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import folds as fo
from panelwatch.operators import panel as pa
from panelwatch.plans.queries import QUERIES
from panelwatch.settings import Settings

MONDAY = date(2021, 1, 4)


def weeks(n, start=MONDAY):
    return [start + timedelta(days=7 * i) for i in range(n)]


def cells(spark, units, n, label=lambda u, i: 0):
    rows = [(w, u, label(u, i), label(u, i)) for u in range(units) for i, w in enumerate(weeks(n))]
    return spark.createDataFrame(
        rows, "week_start date, unit_id long, n_eventos long, deslizamiento int"
    )


def test_grid_is_dense_and_counts_events(spark):
    units = spark.createDataFrame([(1,), (2,), (2,)], "unit_id long")
    events = spark.createDataFrame(
        [(1, date(2021, 1, 10)), (1, date(2021, 1, 4)), (2, date(2021, 1, 11)), (9, MONDAY)],
        "unit_id long, fecha date",
    )
    first, last = F.lit("2021-01-05").cast("date"), F.lit("2021-01-20").cast("date")
    got = pa.panel_grid(units, events, first, last).toPandas()
    assert len(got) == 3 * 2
    by_cell = got.set_index(["unit_id", "week_start"]).n_eventos
    assert by_cell[(1, MONDAY)] == 2 and by_cell[(2, date(2021, 1, 11))] == 1
    assert by_cell.sum() == 3 and got.deslizamiento.sum() == 2


def test_lead_labels_drop_each_units_last_week(spark):
    values = {0: [0, 1, 0, 1], 1: [1, 0, 1, 0]}
    df = cells(spark, 2, 4, lambda u, i: values[u][i])
    got = pa.target_by_unit(df).orderBy("unit_id", "week_start").toPandas()
    assert got.deslizamiento.tolist() == [1, 0, 1, 0, 1, 0]
    assert got.week_start.max() == weeks(4)[2]


def test_row_lead_and_calendar_lead_differ_on_gaps(spark):
    ws = weeks(5)
    df = spark.createDataFrame(
        [(ws[0], 1, 0, 0), (ws[1], 1, 0, 0), (ws[4], 1, 1, 1)],
        "week_start date, unit_id long, n_eventos long, deslizamiento int",
    )
    assert pa.target_by_unit(df).count() == 2
    assert pa.target_by_unit(df, calendar=True).count() == 1


@pytest.mark.parametrize(
    "values, plain, strict",
    [([1.0, 2.0], True, True), ([1.0, 2.0, None], False, True), ([1.0, 25.0], False, False),
     ([1.5, 2.0], False, False)],
)
def test_circular_proxy(spark, values, plain, strict):
    df = spark.createDataFrame([(v,) for v in values], "precip_acum_14d double")
    assert pa.circular_proxy(df, "precip_acum_14d").first().is_proxy is plain
    assert pa.circular_proxy(df, "precip_acum_14d", True).first().is_proxy is strict
    if plain:
        with pytest.raises(ValueError):
            pa.assert_not_proxy(df)


def test_negatives_are_dry_and_stable_and_no_positive_is_lost(spark):
    df = cells(spark, 8, 8, lambda u, i: int(u == i))
    rain = spark.createDataFrame(list(zip(weeks(8), map(float, range(8)))), "week_start date, precip_acum_14d double")
    units = spark.createDataFrame([(u, float(u)) for u in range(8)], "unit_id long, up_area double")
    got = pa.pseudo_absences(df, rain, units).toPandas()
    assert got.deslizamiento.sum() == 8
    negatives = got[got.deslizamiento == 0]
    assert set(negatives.unit_id) == {0, 1} and set(negatives.week_start) == set(weeks(2))
    assert len(negatives) == 2


def test_gate_reports_and_raises(spark):
    df = cells(spark, 4, 20, lambda u, i: 1).withColumn("x", F.lit(None).cast("double"))
    settings = Settings(min_positives=50, min_coverage=0.3)
    gate = pa.quality_gate(df, ["x"], settings, 1)
    row = gate.first()
    assert row.n_pos == 80 and row.n_weeks == 20 and row.null_features == "x" and not row.ok
    with pytest.raises(ValueError):
        pa.assert_quality(gate)
    pa.assert_quality(pa.quality_gate(df, [], settings, 1))


def test_year_slice_uses_the_monday_or_the_sunday(spark):
    df = spark.createDataFrame([(date(2018, 12, 31),), (date(2019, 1, 7),)], "week_start date")
    assert pa.year_slice(df, 2019, 2019).count() == 1
    assert pa.year_slice(df, 2019, 2019, anchor="end").count() == 2


def test_next_week_target_of_the_last_week(spark):
    df = spark.createDataFrame(list(zip(weeks(3), [0, 2, 0])), "week_start date, n_deslizamientos long")
    label = lambda parity: [r.deslizamiento for r in pa.next_week_target(df, parity).orderBy("week_start").collect()]
    assert label(False) == [1, 0, None] and label(True) == [1, 0, 0]


@pytest.mark.parametrize("n, k, size, first", [(20, 4, 4, 4), (209, 4, 41, 45), (24, 3, 6, 6)])
def test_folds(spark, n, k, size, first):
    df = cells(spark, 2, n)
    table = fo.fold_table(df, k).toPandas()
    assert sorted(table.fold.unique()) == list(range(1, k + 1))
    for fold, part in table.groupby("fold"):
        train, val = (part[part.side == s].week_start for s in ("train", "val"))
        assert len(val) == size and train.max() < val.min()
        assert len(train) == first + (fold - 1) * size
    assert table[table.side == "val"].week_start.max() == weeks(n)[-1]
    fo.assert_disjoint(fo.fold_table(df, k))


def test_fold_sides_hold_the_same_rows_as_the_table(spark):
    df = cells(spark, 3, 20)
    for fold, sides in fo.fold_sides(df).items():
        for side, rows in sides.items():
            want = df.join(fo.fold_table(df), "week_start").where((F.col("fold") == fold) & (F.col("side") == side))
            assert rows.count() == want.count()


def test_overlap_is_noticed(spark):
    table = spark.createDataFrame(
        [(1, MONDAY, "train"), (1, MONDAY, "val")], "fold int, week_start date, side string"
    )
    with pytest.raises(AssertionError):
        fo.assert_disjoint(table)


def test_class_weights_and_balance(spark):
    df = cells(spark, 1, 10, lambda u, i: int(i < 2))
    weights = {r.clase: r.peso for r in pa.class_weights(df).collect()}
    assert weights == {1: 2.5, 0: 0.625}
    row = pa.class_balance(df).first()
    assert (row.n, row.n_pos, row.pct_pos, row.ratio) == (10, 2, 20.0, 4.0)


def test_summary_matches_pandas(spark):
    p = pd.DataFrame({"a": [1.0, 2.0, None, 4.0], "b": [3.0, 3.0, 3.0, 9.0]})
    got = pa.feature_summary(spark.createDataFrame(p).replace(float("nan"), None), ["a", "b"]).toPandas().set_index("feature")
    want = p.describe().T
    for ours, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%")):
        assert got[ours].loc[["a", "b"]].tolist() == pytest.approx(want[theirs].tolist())


def test_a_unit_with_a_mild_event_is_active(spark, tmp_path):
    spark.createDataFrame([(u, 1.0) for u in (1, 2, 3)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    day = date(2000, 1, 3)
    rows = [(1, 1, 1, 10.0, "R", day), (2, 1, 2, 50.0, "N", day), (9, 1, 2, 50.0, "R", day)]
    schema = "l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate date"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r.unit_id for r in QUERIES["inactive_units"](spark, str(tmp_path)).collect()} == {2, 3}
