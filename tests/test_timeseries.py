from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import timeseries as ts
from panelwatch.settings import RAIN_FEATURES


def series(spark, start, values, name="precip_mm"):
    rows = [(start + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"fecha date, {name} double")


def pandas_rain(daily: pd.DataFrame, lag=1) -> pd.DataFrame:
    """The published definition, by way of the filled daily calendar."""
    s = daily.groupby("fecha").precip_mm.sum()
    s.index = pd.to_datetime(s.index)
    s = s.reindex(pd.date_range(s.index.min(), s.index.max()), fill_value=0.0)
    d = pd.DataFrame(
        {
            "precip_acum_14d": s.rolling(14, min_periods=7).sum(),
            "precip_acum_7d": s.rolling(7, min_periods=4).sum(),
            "precip_acum_3d": s.rolling(3, min_periods=2).sum(),
            "precip_max_diario_14d": s.rolling(14, min_periods=7).max(),
            "precip_dias_lluvia_14d": (s > 0).astype(int).rolling(14, min_periods=7).sum(),
        }
    )
    weekly = d.groupby(s.index.to_period("W")).last()
    return weekly.shift(lag)


def collect(df):
    return df.orderBy("week_start").toPandas()


@pytest.mark.parametrize("days", [1, 2, 3, 5, 12, 56, 61])
def test_same_as_the_daily_calendar(spark, days):
    rng = np.random.default_rng(days)
    values = np.where(rng.random(days) < 0.4, 0.0, rng.integers(0, 40, days)).astype(float)
    df = series(spark, date(2021, 1, 1), values.tolist())
    got, want = collect(ts.weekly_rain_features(df)), pandas_rain(df.toPandas())
    assert len(got) == len(want)
    for f in RAIN_FEATURES:
        np.testing.assert_allclose(got[f].astype(float), want[f].astype(float))


def test_gaps_are_zero_and_whole_empty_weeks_appear(spark):
    days = [date(2021, 1, 1), date(2021, 1, 2), date(2021, 2, 10), date(2021, 2, 10), date(2021, 3, 1)]
    df = spark.createDataFrame([(d, 3.0) for d in days], "fecha date, precip_mm double")
    got, want = collect(ts.weekly_rain_features(df)), pandas_rain(df.toPandas())
    assert len(got) == len(want) == 10
    for f in RAIN_FEATURES:
        np.testing.assert_allclose(got[f].astype(float), want[f].astype(float))


def test_first_week_is_null_and_later_ones_bounded(spark):
    got = collect(ts.weekly_rain_features(series(spark, date(2021, 1, 1), [10.0] * 56)))
    assert got.loc[0, list(RAIN_FEATURES)].isna().all()
    assert got.loc[3:, "precip_acum_14d"].between(0, 200).all()


def test_a_partial_first_week_keeps_its_short_windows(spark):
    got = collect(ts.weekly_rain_features(series(spark, date(2021, 1, 1), [1.0] * 12), lag_weeks=0))
    first = got.loc[0]
    assert np.isnan(first.precip_acum_14d) and np.isnan(first.precip_acum_7d)
    assert first.precip_acum_3d == 3.0


def test_a_week_does_not_see_itself(spark):
    base = [1.0] * 40
    changed = base.copy()
    week = date(2021, 1, 18)
    for i in range(7):
        changed[(week - date(2021, 1, 1)).days + i] = 99.0
    a = collect(ts.weekly_rain_features(series(spark, date(2021, 1, 1), base)))
    b = collect(ts.weekly_rain_features(series(spark, date(2021, 1, 1), changed)))
    same = a.week_start <= week
    pd.testing.assert_frame_equal(a[same], b[same])
    assert not a[~same].equals(b[~same])


def test_series_do_not_mix(spark):
    one = series(spark, date(2021, 1, 1), [1.0] * 30)
    two = series(spark, date(2021, 1, 20), [5.0] * 60)
    both = one.withColumn("u", F.lit(1)).union(two.withColumn("u", F.lit(2)))
    got = ts.weekly_rain_features(both, ["u"])
    for u, single in ((1, one), (2, two)):
        a = collect(got.where(F.col("u") == u)).drop(columns="u")
        pd.testing.assert_frame_equal(a, collect(ts.weekly_rain_features(single)))


def test_station_counts_are_averaged_over_the_days_of_the_week(spark):
    rows = [(date(2021, 1, 4), 1.0)] * 3 + [(date(2021, 1, 7), 2.0)]
    df = spark.createDataFrame(rows, "fecha date, precip_mm double")
    got = collect(ts.weekly_rain_features(df, lag_weeks=0, station_counts=True))
    assert got.n_estaciones.tolist() == [1.0]  # four readings over four days


def test_interpolation(spark):
    df = series(spark, date(2021, 1, 1), [None, 1.0, None, 3.0, None], "value")
    got = ts.interpolate_daily(df).orderBy("fecha").toPandas().value
    assert [None if np.isnan(v) else v for v in got] == [None, 1.0, 2.0, 3.0, 3.0]


def test_interpolation_over_missing_rows_and_empty_series(spark):
    df = spark.createDataFrame(
        [("a", date(2021, 1, 1), 1.0), ("a", date(2021, 1, 5), 9.0), ("b", date(2021, 1, 1), None),
         ("b", date(2021, 1, 3), None)],
        "k string, fecha date, value double",
    )
    got = ts.interpolate_daily(df, ["k"]).orderBy("k", "fecha").toPandas()
    assert got[got.k == "a"].value.tolist() == [1.0, 3.0, 5.0, 7.0, 9.0]
    assert got[got.k == "b"].value.isna().tolist() == [True] * 3


def test_soil_is_a_lagged_rolling_mean(spark):
    rng = np.random.default_rng(1)
    values = [None if rng.random() < 0.3 else float(v) for v in rng.integers(0, 50, 60)]
    df = series(spark, date(2021, 1, 1), values, "soil_moisture_m3m3")
    s = pd.Series(values, index=pd.date_range("2021-01-01", periods=60), dtype=float)
    want = s.interpolate().rolling(14, min_periods=7).mean().groupby(s.index.to_period("W")).last().shift(1)
    got = collect(ts.weekly_soil_features(df)).soil_moisture_14d
    np.testing.assert_allclose(got.astype(float), want)


def test_window_audit(spark):
    got = collect(ts.window_audit(series(spark, date(2021, 1, 4), [1.0] * 16)))
    assert got.dias_semana.tolist() == [7, 7, 2]
    assert got.dias_semana_previa.tolist() == [0, 7, 7]


def test_monthly_features(spark):
    rows = [("x", date(2021, m, 1), float(m)) for m in range(1, 8)]
    df = spark.createDataFrame(rows, "departamento string, mes_inicio date, precip_suma double")
    got = ts.monthly_features(df, ["departamento"]).orderBy("mes_inicio").toPandas()
    assert np.isnan(got.precip_lag1[0]) and got.precip_lag1[6] == 6.0
    assert got.precip_acum3m[6] == 18.0 and got.precip_acum6m[6] == 27.0 and got.precip_max3m[6] == 7.0
